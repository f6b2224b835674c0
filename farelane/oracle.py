"""DuckDB SQL for every registered query (the independent oracle).

The SQL is written from the operator definitions, not generated from the
Spark plans.  Shared building blocks are CTE fragments below; tables are the
driver's views (lineitem, orders, customer, nation, region, events, ...).
"""

from __future__ import annotations

# Written out here, not taken from the package, so that a wrong list there shows.
RATECODE_SQL = """(VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
  (5, 'Negotiated fare'), (6, 'Group ride'), (99, 'Unknown')) AS rc(RatecodeID, RatecodeDesc)"""
PAYMENT_SQL = """(VALUES (0, 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
  (5, 'Unknown'), (6, 'Voided trip')) AS pt(payment_type, payment_type_desc)"""
TRIP_TYPE_SQL = "(VALUES (1, 'Street-hail'), (2, 'Dispatch'), (3, 'NA')) AS tt(trip_type, trip_type_desc)"

ZONE_SQL = """(SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         'Region ' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

# Trip lines (copy 0) and the raw union with reversal / duplicate copies.
TRIPS_CTE = """
t0 AS (
  SELECT CAST(l_suppkey % 3 AS INTEGER) AS VendorID,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE o_orderdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT))
              - to_years(CASE WHEN l_orderkey % 53 = 0 THEN 3 ELSE 0 END) END AS pickup_datetime,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE o_orderdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT))
              + to_minutes(CAST(CAST(l_quantity AS INTEGER) * (CASE WHEN l_partkey % 89 = 0 THEN -1
                                                                    WHEN l_partkey % 83 = 0 THEN 30
                                                                    ELSE 1 END) AS BIGINT)) END AS dropoff_datetime,
    CAST(year(o_orderdate) AS VARCHAR) AS file_year,
    lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS file_month,
    CAST(CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE l_suppkey % 25 END AS INTEGER) AS PULocationID,
    CAST(c_nationkey AS INTEGER) AS DOLocationID,
    CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber - 1 END AS BIGINT) AS passenger_count,
    CASE WHEN l_partkey % 61 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity / 4 END AS trip_distance,
    l_extendedprice / 1000 AS fare_amount,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount * 10 END AS tip_amount,
    l_tax * 10 AS tolls_amount,
    CAST(CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_partkey % 6 + 1 END AS BIGINT) AS RatecodeID,
    CAST(CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_orderkey % 5 END AS BIGINT) AS payment_type,
    CASE WHEN l_linenumber = 2 THEN NULL WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber % 2 + 1 END AS BIGINT) AS trip_type,
    CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE (l_partkey % 3) * 0.5 END AS DOUBLE) AS extra,
    CAST(CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 0.5 END AS DOUBLE) AS mta_tax,
    CAST(CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE 0.25 END AS DOUBLE) AS improvement_surcharge,
    CAST(CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE (l_linenumber % 2) * 2.5 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_suppkey % 4 = 0 THEN 1.75 ELSE 0 END AS DOUBLE) AS Airport_fee,
    CAST(CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE (l_partkey % 5) * 0.25 END AS DOUBLE) AS ehail_fee,
    CAST(CASE WHEN l_linenumber = 5 THEN NULL WHEN l_partkey % 2 = 1 THEN 0.75 ELSE 0 END AS DOUBLE) AS cbd_congestion_fee,
    l_orderkey, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
raw AS (
  SELECT *, 0 AS copy_no FROM t0
  UNION ALL
  SELECT * REPLACE (-fare_amount AS fare_amount, -tip_amount AS tip_amount, -tolls_amount AS tolls_amount, -extra AS extra,
                    -mta_tax AS mta_tax, -improvement_surcharge AS improvement_surcharge,
                    -congestion_surcharge AS congestion_surcharge, -Airport_fee AS Airport_fee, -ehail_fee AS ehail_fee,
                    -cbd_congestion_fee AS cbd_congestion_fee), 1
  FROM t0 WHERE l_orderkey % 50 = 0
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS tip_amount), 2 FROM t0 WHERE l_orderkey % 40 = 1
)"""


def _harmonized(flavour: str) -> str:
    """Raw trips of a flavour after harmonisation (common names): a, b, or v
    (flavour a in vintages: the congestion fee of the district from 1998)."""
    trip_type = "trip_type" if flavour == "b" else "3"
    none = "CAST(NULL AS DOUBLE)"
    airport, ehail = (none, "ehail_fee") if flavour == "b" else ("Airport_fee", none)
    cbd = {"a": none, "b": "cbd_congestion_fee",
           "v": f"CASE WHEN CAST(file_year AS INTEGER) >= 1998 THEN cbd_congestion_fee ELSE {none} END"}[flavour]
    return f"""
h AS (
  SELECT VendorID, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, RatecodeID,
         store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount,
         extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, congestion_surcharge,
         fare_amount + tip_amount + tolls_amount AS total_amount,
         {airport} AS Airport_fee, {ehail} AS ehail_fee, {cbd} AS cbd_congestion_fee, {trip_type} AS trip_type,
         file_year, file_month, l_orderkey, l_partkey, l_suppkey, copy_no
  FROM raw
)"""


def _with_year(ts: str) -> str:
    leap = "((fy % 4 = 0 AND fy % 100 <> 0) OR fy % 400 = 0)"
    return (f"CASE WHEN month({ts}) = 2 AND day({ts}) = 29 AND NOT {leap} THEN NULL "
            f"ELSE make_timestamp(fy, month({ts}), day({ts}), hour({ts}), minute({ts}), CAST(second({ts}) AS DOUBLE)) END")


def _nye(ts: str, y: str) -> str:
    return f"(year({ts}) = {y} AND month({ts}) = 12 AND day({ts}) = 31)"


def _nyd(ts: str, y: str) -> str:
    return f"(year({ts}) = {y} AND month({ts}) = 1 AND day({ts}) = 1)"


TOTAL_SQL = """coalesce(fare_amount, 0) + coalesce(extra, 0) + coalesce(mta_tax, 0) + coalesce(tip_amount, 0)
  + coalesce(tolls_amount, 0) + coalesce(improvement_surcharge, 0) + coalesce(congestion_surcharge, 0)
  + coalesce(Airport_fee, 0) + coalesce(ehail_fee, 0) + coalesce(cbd_congestion_fee, 0)"""

# d: total recomputed + timestamps repaired + clamped (input CTE: h).
REPAIR_CTE = f"""
d1 AS (SELECT * REPLACE ({TOTAL_SQL} AS total_amount), TRY_CAST(file_year AS INTEGER) AS fy FROM h),
d2 AS (SELECT * REPLACE (CASE WHEN year(pickup_datetime) = fy THEN pickup_datetime
                              WHEN {_nye('pickup_datetime', 'fy - 1')} AND {_nyd('dropoff_datetime', 'fy')} THEN pickup_datetime
                              ELSE {_with_year('pickup_datetime')} END AS pickup_datetime) FROM d1),
d3 AS (SELECT * REPLACE (CASE WHEN year(dropoff_datetime) = fy THEN dropoff_datetime
                              WHEN {_nye('pickup_datetime', 'fy')} AND {_nyd('dropoff_datetime', 'fy + 1')} THEN dropoff_datetime
                              ELSE {_with_year('dropoff_datetime')} END AS dropoff_datetime) FROM d2),
d AS (SELECT * REPLACE (CASE WHEN dropoff_datetime < pickup_datetime THEN pickup_datetime
                             ELSE dropoff_datetime END AS dropoff_datetime) FROM d3)"""

REV_KEYS = "VendorID, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_distance"
DEDUP_KEYS = "VendorID, pickup_datetime, dropoff_datetime, trip_distance, fare_amount, PULocationID, DOLocationID"
TIEBREAK = "total_amount DESC NULLS LAST, l_orderkey, l_partkey, l_suppkey, copy_no"

# k: reversal pairs removed, filters, keep-best (input CTE: d).
CLEAN_CTE = f"""
rev AS (SELECT {REV_KEYS} FROM d GROUP BY {REV_KEYS} HAVING sum(total_amount) = 0 AND count(*) = 2),
j1 AS (SELECT * FROM d WHERE NOT EXISTS (
         SELECT 1 FROM rev r WHERE {' AND '.join(f'r.{k} = d.{k}' for k in REV_KEYS.split(', '))})),
f AS (SELECT * FROM j1 WHERE trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0
                         AND (trip_distance > 0 OR total_amount > 0)),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY {DEDUP_KEYS} ORDER BY {TIEBREAK}) = 1)"""


ZERO_FILLED = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
               "congestion_surcharge", "Airport_fee", "ehail_fee", "cbd_congestion_fee")
CODE_FILLED = {"PULocationID": "24", "DOLocationID": "24", "trip_type": "3", "RatecodeID": "99",
               "store_and_fwd_flag": "'N'", "payment_type": "5"}


def _impute_cte(unknown_zone: int) -> str:
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ZERO_FILLED)
    fill = "make_timestamp(fy, TRY_CAST(file_month AS INTEGER), 1, 0, 0, 0.0)"
    return f"""
i1 AS (SELECT * REPLACE (
         CASE WHEN passenger_count IS NULL OR passenger_count = 0 THEN 1 ELSE passenger_count END AS passenger_count,
         {zero},
         coalesce(PULocationID, {unknown_zone}) AS PULocationID, coalesce(DOLocationID, {unknown_zone}) AS DOLocationID,
         coalesce(trip_type, 3) AS trip_type, coalesce(RatecodeID, 99) AS RatecodeID,
         coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, coalesce(payment_type, 5) AS payment_type,
         coalesce(pickup_datetime, {fill}) AS pickup_datetime,
         coalesce(dropoff_datetime, {fill}) AS dropoff_datetime) FROM k),
i AS (SELECT * REPLACE (CASE WHEN dropoff_datetime < pickup_datetime THEN pickup_datetime
                             ELSE dropoff_datetime END AS dropoff_datetime) FROM i1)"""


DURATION_SQL = "(epoch(date_trunc('second', dropoff_datetime)) - epoch(date_trunc('second', pickup_datetime))) / 60"

MEASURE_CTE = f"""
m1 AS (SELECT *, {DURATION_SQL} AS trip_duration_min FROM e),
m2 AS (SELECT *, trip_distance / nullif(trip_duration_min, 0) AS miles_per_minute,
              fare_amount / nullif(trip_distance, 0) AS fare_amount_per_mile,
              fare_amount / nullif(trip_duration_min, 0) AS fare_amount_per_min FROM m1),
m AS (SELECT *, miles_per_minute * 60 AS miles_per_hour,
        CASE WHEN miles_per_minute < 0.01 OR miles_per_minute > 2 THEN TRUE
             WHEN trip_distance > 100 AND trip_duration_min < 60 THEN TRUE
             WHEN trip_distance < 20 AND trip_duration_min > 240 THEN TRUE
             WHEN trip_distance < 50 AND trip_duration_min > 480 THEN TRUE
             WHEN trip_distance < 100 AND trip_duration_min > 720 THEN TRUE
             ELSE FALSE END AS trip_outlier_flag,
        CASE WHEN fare_amount_per_mile < 0 OR fare_amount_per_mile > 30 THEN TRUE
             WHEN fare_amount_per_min < 0 OR fare_amount_per_min > 15 THEN TRUE
             WHEN fare_amount_per_min = 0 THEN TRUE
             ELSE FALSE END AS fare_amount_outlier_flag FROM m2)"""

ENRICH_CTE = f"""
e AS (SELECT i.*, rc.RatecodeDesc, pt.payment_type_desc,
             pu.Borough AS PU_Borough, pu.Zone AS PU_Zone, pu.service_zone AS PU_service_zone,
             dz.Borough AS DO_Borough, dz.Zone AS DO_Zone, dz.service_zone AS DO_service_zone,
             year(pickup_datetime) AS pickup_year, month(pickup_datetime) AS pickup_month,
             day(pickup_datetime) AS pickup_day, year(dropoff_datetime) AS dropoff_year,
             month(dropoff_datetime) AS dropoff_month, day(dropoff_datetime) AS dropoff_day
      FROM i LEFT JOIN {RATECODE_SQL} ON i.RatecodeID = rc.RatecodeID
             LEFT JOIN {PAYMENT_SQL} ON i.payment_type = pt.payment_type
             LEFT JOIN {ZONE_SQL} pu ON i.PULocationID = pu.LocationID
             LEFT JOIN {ZONE_SQL} dz ON i.DOLocationID = dz.LocationID)"""


# The curated layout: source [AS name] type, in order.
CURATED_LAYOUT = """file_year VARCHAR, file_month VARCHAR, VendorID AS vendor_id INTEGER,
pickup_datetime TIMESTAMP, pickup_year INTEGER, pickup_month INTEGER, pickup_day INTEGER,
dropoff_datetime TIMESTAMP, dropoff_year INTEGER, dropoff_month INTEGER, dropoff_day INTEGER,
PULocationID AS pu_location_id INTEGER, PU_Borough AS pu_borough VARCHAR, PU_Zone AS pu_zone VARCHAR,
PU_service_zone AS pu_service_zone VARCHAR, DOLocationID AS do_location_id INTEGER, DO_Borough AS do_borough VARCHAR,
DO_Zone AS do_zone VARCHAR, DO_service_zone AS do_service_zone VARCHAR, RatecodeID AS ratecode_id BIGINT,
RatecodeDesc AS ratecode_desc VARCHAR, payment_type BIGINT, payment_type_desc VARCHAR, store_and_fwd_flag VARCHAR,
passenger_count BIGINT, trip_distance DOUBLE, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE,
tolls_amount DOUBLE, improvement_surcharge DOUBLE, congestion_surcharge DOUBLE, Airport_fee AS airport_fee DOUBLE,
ehail_fee DOUBLE, cbd_congestion_fee DOUBLE, total_amount DOUBLE, trip_duration_min DOUBLE, miles_per_minute DOUBLE,
miles_per_hour DOUBLE, trip_outlier_flag BOOLEAN, fare_amount_per_mile DOUBLE, fare_amount_per_min DOUBLE,
fare_amount_outlier_flag BOOLEAN"""
CURATED_NAMES = [item.split()[-2] for item in CURATED_LAYOUT.split(",")]
CURATED_SELECT = ",\n  ".join(f"CAST({w[0]} AS {w[-1]}) AS {w[-2]}" for w in (item.split() for item in CURATED_LAYOUT.split(",")))
# The quality gate.
NOT_ZERO = ["passenger_count"]
NOT_NEGATIVE = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]
NOT_NULL = CURATED_NAMES[:CURATED_NAMES.index("trip_duration_min")]
UNIQUE_KEY = ["vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount", "pu_location_id", "do_location_id"]


def _stages(flavour: str, unknown_zone: int) -> list[tuple[str, str]]:
    return [("raw", TRIPS_CTE), ("h", _harmonized(flavour)), ("d", REPAIR_CTE), ("k", CLEAN_CTE),
            ("i", _impute_cte(unknown_zone)), ("e", ENRICH_CTE), ("m", MEASURE_CTE),
            ("cur", f"\ncur AS (SELECT\n  {CURATED_SELECT}\nFROM m)")]


def ctes(upto: str = "cur", flavour: str = "a", unknown_zone: int = 24, extra: str = "") -> str:
    """``WITH`` clause of the trip chain up to and including stage ``upto``
    (raw, h, d, k, i, e, m, cur), plus optional extra CTEs."""
    parts = []
    for name, text in _stages(flavour, unknown_zone):
        parts.append(text)
        if name == upto:
            break
    if extra:
        parts.append("\n" + extra)
    return "WITH " + ",".join(parts) + "\n"


def curated_sql(flavour: str = "a") -> str:
    return ctes("cur", flavour) + "SELECT * FROM cur"
