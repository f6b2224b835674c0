"""The curated trip model: column names, keys, defaults and rule thresholds.

The block marked FIXED VALUES must keep these exact values for results to
match the behaviour being reproduced; everything else is derived from it.
Column names are parameters of the operators (see :class:`TripColumns`), so
the same operators also run on other star schemas.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Charge components summed into total_amount, in this addition order.
TOTAL_COMPONENTS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "Airport_fee",
    "ehail_fee", "cbd_congestion_fee",
)

# Exploration variant of the total: NULL-propagating sum of the first eight.
STRICT_TOTAL_COMPONENTS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "Airport_fee",
)

# Charges whose NULL becomes 0.
ZERO_FILL_COLUMNS = (
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "Airport_fee", "ehail_fee", "cbd_congestion_fee",
)

# NULL code -> default code.
CODE_DEFAULTS = {
    "PULocationID": 264,
    "DOLocationID": 264,
    "trip_type": 3,
    "RatecodeID": 99,
    "store_and_fwd_flag": "N",
    "payment_type": 5,
}

# passenger_count NULL or 0 becomes this.
DEFAULT_PASSENGERS = 1

# Code dimensions (code, description).
PAYMENT_TYPES = (
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
)
RATECODES = (
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
)
TRIP_TYPES = (
    (1, "Street-hail"),
    (2, "Dispatch"),
    (3, "NA"),
)

# Trip outlier: any of these (miles_per_minute bounds, then distance/duration pairs).
TRIP_MPM_LOW, TRIP_MPM_HIGH = 0.01, 2
TRIP_DISTANCE_DURATION_RULES = (
    # (distance op, distance, duration op, minutes)
    (">", 100, "<", 60),
    ("<", 20, ">", 60 * 4),
    ("<", 50, ">", 60 * 8),
    ("<", 100, ">", 60 * 12),
)
# Fare outlier: fare per mile outside [0, 30], fare per minute outside [0, 15] or equal 0.
FARE_PER_MILE_LOW, FARE_PER_MILE_HIGH = 0, 30
FARE_PER_MIN_LOW, FARE_PER_MIN_HIGH = 0, 15

# Curated output: (source column, curated column, type), in output order.
CURATED_COLUMNS = (
    ("file_year", "file_year", "string"),
    ("file_month", "file_month", "string"),
    ("VendorID", "vendor_id", "int"),
    ("pickup_datetime", "pickup_datetime", "timestamp"),
    ("pickup_year", "pickup_year", "int"),
    ("pickup_month", "pickup_month", "int"),
    ("pickup_day", "pickup_day", "int"),
    ("dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("dropoff_year", "dropoff_year", "int"),
    ("dropoff_month", "dropoff_month", "int"),
    ("dropoff_day", "dropoff_day", "int"),
    ("PULocationID", "pu_location_id", "int"),
    ("PU_Borough", "pu_borough", "string"),
    ("PU_Zone", "pu_zone", "string"),
    ("PU_service_zone", "pu_service_zone", "string"),
    ("DOLocationID", "do_location_id", "int"),
    ("DO_Borough", "do_borough", "string"),
    ("DO_Zone", "do_zone", "string"),
    ("DO_service_zone", "do_service_zone", "string"),
    ("RatecodeID", "ratecode_id", "bigint"),
    ("RatecodeDesc", "ratecode_desc", "string"),
    ("payment_type", "payment_type", "bigint"),
    ("payment_type_desc", "payment_type_desc", "string"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("passenger_count", "passenger_count", "bigint"),
    ("trip_distance", "trip_distance", "double"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("Airport_fee", "airport_fee", "double"),
    ("ehail_fee", "ehail_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
    ("total_amount", "total_amount", "double"),
    ("trip_duration_min", "trip_duration_min", "double"),
    ("miles_per_minute", "miles_per_minute", "double"),
    ("miles_per_hour", "miles_per_hour", "double"),
    ("trip_outlier_flag", "trip_outlier_flag", "boolean"),
    ("fare_amount_per_mile", "fare_amount_per_mile", "double"),
    ("fare_amount_per_min", "fare_amount_per_min", "double"),
    ("fare_amount_outlier_flag", "fare_amount_outlier_flag", "boolean"),
)

# Quality gate on the curated table.
QUALITY_NOT_ZERO = ("passenger_count",)
QUALITY_NOT_NEGATIVE = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
QUALITY_UNIQUE_KEY = (
    "vendor_id", "pickup_datetime", "dropoff_datetime",
    "trip_distance", "fare_amount", "pu_location_id", "do_location_id",
)
QUALITY_NOT_NULL = (
    "file_year", "file_month", "vendor_id", "pickup_datetime", "pickup_year",
    "pickup_month", "pickup_day", "dropoff_datetime", "dropoff_year",
    "dropoff_month", "dropoff_day", "pu_location_id", "pu_borough", "pu_zone",
    "pu_service_zone", "do_location_id", "do_borough", "do_zone",
    "do_service_zone", "ratecode_id", "ratecode_desc", "payment_type",
    "payment_type_desc", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "airport_fee", "ehail_fee", "cbd_congestion_fee", "total_amount",
)

# Flavour-specific raw column names.
FLAVOUR_A_TIMESTAMPS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
FLAVOUR_B_TIMESTAMPS = ("lpep_pickup_datetime", "lpep_dropoff_datetime")
FLAVOUR_A_TRIP_TYPE = 3

# Raw file names are <vehicle>_tripdata_<yyyy>-<mm>.parquet.
# Year and month of a raw file, taken from the file (or Spark output folder)
# name, never from folders further up the path.
FILE_MONTH_PATTERN = r"_(\d{4}-\d{2})\.parquet(?:/[^/]*)?$"

# Run modes.
PAST_MONTHS_MAX = 300           # past_months N must satisfy 0 < N < 300
SPECIFIC_MONTH_MIN = 200900     # specific_month yyyymm must be greater
PUBLICATION_LAG_MONTHS = 2      # Jan/Feb fall back to the previous year
FIRST_PUBLISHED_YEAR = 2022
VEHICLES = ("yellow", "green", "fhv", "fhvhv")

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TripColumns:
    """Column names and defaults the trip operators work on."""

    vendor: str = "VendorID"
    pickup: str = "pickup_datetime"
    dropoff: str = "dropoff_datetime"
    pu_location: str = "PULocationID"
    do_location: str = "DOLocationID"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    total: str = "total_amount"
    passengers: str = "passenger_count"
    file_year: str = "file_year"
    file_month: str = "file_month"
    total_components: tuple = TOTAL_COMPONENTS
    zero_fill: tuple = ZERO_FILL_COLUMNS
    code_defaults: dict = field(default_factory=lambda: dict(CODE_DEFAULTS))
    # Further keys of pairs and duplicates.  Empty: they are searched in all
    # rows of a load.  File year and month: inside each monthly file only, so
    # that the result does not depend on which months are loaded together.
    scope: tuple = ()
    # Total order for keep-best ties after total_amount desc.  ``None`` means
    # "every other column", which is deterministic for any input.
    tiebreak: tuple | None = None

    @property
    def reversal_keys(self) -> tuple:
        return (self.vendor, self.pickup, self.dropoff, self.pu_location,
                self.do_location, self.distance, *self.scope)

    @property
    def dedup_keys(self) -> tuple:
        return (self.vendor, self.pickup, self.dropoff, self.distance,
                self.fare, self.pu_location, self.do_location, *self.scope)

    def by_month(self) -> "TripColumns":
        return self.with_(scope=(self.file_year, self.file_month))

    def with_(self, **kw) -> "TripColumns":
        return replace(self, **kw)


DEFAULT_COLUMNS = TripColumns()
