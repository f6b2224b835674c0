"""Trip records derived from the star-schema test tables.

Lines of ``lineitem`` joined to their order and customer become trips with
deterministic dirt: NULL and out-of-year timestamps, reversed intervals,
NULL locations and codes, zero distances, reversal copies (negated charges)
and duplicate copies (missing tip).  ``(l_orderkey, l_partkey, l_suppkey,
copy_no)`` identifies a row and is the keep-best tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane import spec
from farelane.spec import TripColumns

IDENTITY = ("l_orderkey", "l_partkey", "l_suppkey", "copy_no")

# Operator settings for this data: nation key 24 plays the unknown zone.
ADAPTER_COLUMNS = TripColumns(
    tiebreak=IDENTITY,
    code_defaults={**spec.CODE_DEFAULTS, "PULocationID": 24, "DOLocationID": 24},
)


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trip is derived from, once for every copy of it: the line, its
    order's date and file month, its customer's nation and ``copy_no`` (0, and
    1 where orderkey % 50 = 0, and 2 where orderkey % 40 = 1).  Orders meet
    their customers first, so that lines are shuffled once and narrow."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cu = spark.read.parquet(f"{sf_dir}/customer.parquet")
    dated = od.join(cu, od.o_custkey == cu.c_custkey).select("o_orderkey", "o_orderdate", "c_nationkey")
    ok = F.col("l_orderkey")
    copies = F.array_compact(F.array(F.lit(0), F.when(ok % 50 == 0, F.lit(1)), F.when(ok % 40 == 1, F.lit(2))))
    return li.join(dated, li.l_orderkey == dated.o_orderkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "o_orderdate", "c_nationkey", F.explode(copies).alias("copy_no"),
        F.year("o_orderdate").cast("string").alias("file_year"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("file_month"))


def trips_of(lines: DataFrame) -> DataFrame:
    """Trips with common column names from :func:`source_lines`.  Columns of
    other names pass through."""
    pk, sk, ok, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")
    base = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (pk % 1440).cast("int"), F.lit(0))
    years_back = F.when(ok % 53 == 0, F.lit(3)).otherwise(F.lit(0))
    stretch = (F.when(pk % 89 == 0, F.lit(-1)).when(pk % 83 == 0, F.lit(30)).otherwise(F.lit(1)))
    no_time = pk % 97 == 0
    own = {"l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "o_orderdate", "c_nationkey",
           "l_orderkey", "l_partkey", "l_suppkey", "copy_no", "file_year", "file_month"}
    t = lines.select(
        (sk % 3).cast("int").alias("VendorID"),
        _null_when(no_time, base - F.make_ym_interval(years_back, F.lit(0))).alias("pickup_datetime"),
        _null_when(no_time, base + F.make_dt_interval(
            F.lit(0), F.lit(0), F.col("l_quantity").cast("int") * stretch, F.lit(0))).alias("dropoff_datetime"),
        "file_year", "file_month",
        _null_when(sk % 31 == 0, sk % 25).cast("int").alias("PULocationID"),
        F.col("c_nationkey").cast("int").alias("DOLocationID"),
        _null_when(ln == 7, ln - 1).cast("bigint").alias("passenger_count"),
        F.when(pk % 61 == 0, F.lit(0.0)).otherwise(F.col("l_quantity") / 4).alias("trip_distance"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"),
        _null_when(ln == 3, F.col("l_discount") * 10).alias("tip_amount"),
        (F.col("l_tax") * 10).alias("tolls_amount"),
        _null_when(ok % 17 == 0, pk % 6 + 1).cast("bigint").alias("RatecodeID"),
        _null_when(sk % 13 == 0, ok % 5).cast("bigint").alias("payment_type"),
        F.when(ln == 2, F.lit(None)).when(F.col("l_returnflag") == "R", F.lit("Y"))
         .otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        _null_when(ok % 11 == 0, ln % 2 + 1).cast("bigint").alias("trip_type"),
        _null_when(ln == 4, (pk % 3) * 0.5).alias("extra"),
        _null_when(sk % 10 == 0, F.lit(0.5)).alias("mta_tax"),
        _null_when(ok % 9 == 0, F.lit(0.25)).alias("improvement_surcharge"),
        _null_when(pk % 7 == 0, (ln % 2) * 2.5).alias("congestion_surcharge"),
        _null_when(ok % 19 == 0, F.when(sk % 4 == 0, 1.75).otherwise(0.0)).alias("Airport_fee"),
        _null_when(ok % 23 == 0, (pk % 5) * 0.25).alias("ehail_fee"),
        _null_when(ln == 5, F.when(pk % 2 == 1, 0.75).otherwise(0.0)).alias("cbd_congestion_fee"),
        ok.alias("l_orderkey"), pk.alias("l_partkey"), sk.alias("l_suppkey"), "copy_no",
        *[c for c in lines.columns if c not in own],
    )
    back, again = F.col("copy_no") == 1, F.col("copy_no") == 2
    charges = {x: F.when(back, -F.col(x)).otherwise(F.col(x)) for x in spec.TOTAL_COMPONENTS}
    return t.withColumns({**charges, "tip_amount": F.when(again, F.lit(None)).otherwise(charges["tip_amount"])})


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip lines plus reversal copies (charges negated, orderkey % 50 = 0)
    and duplicate copies (tip missing, orderkey % 40 = 1)."""
    return trips_of(source_lines(spark, sf_dir))


def _raw_total() -> Column:
    return F.col("fare_amount") + F.col("tip_amount") + F.col("tolls_amount")


def flavour_a_raw(spark: SparkSession, sf_dir: str, cbd: bool = False) -> DataFrame:
    """Yellow-shaped raw records (tpep_* names, airport fee; no trip type, e-hail or CBD fee)."""
    return flavour_a_of(source_lines(spark, sf_dir), cbd)


def _arranged(t: DataFrame) -> list[str]:
    """The file name that :func:`farelane.sources.files.by_month_file` gave the lines."""
    return [c for c in t.columns if c == "raw_file"]


def flavour_a_of(lines: DataFrame, cbd: bool = False) -> DataFrame:
    """Yellow-shaped raw records of lines."""
    t = trips_of(lines)
    return t.select(
        "VendorID",
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag",
        "PULocationID", "DOLocationID", "payment_type", "fare_amount",
        "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
        _raw_total().alias("total_amount"), "Airport_fee", *(["cbd_congestion_fee"] if cbd else []),
        "file_year", "file_month", *IDENTITY, *_arranged(t))


def flavour_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green-shaped raw records (lpep_* names, e-hail fee, trip type, CBD fee)."""
    return flavour_b_of(source_lines(spark, sf_dir))


def flavour_b_of(lines: DataFrame) -> DataFrame:
    """Green-shaped raw records of lines."""
    t = trips_of(lines)
    return t.select(
        "VendorID",
        F.col("pickup_datetime").alias("lpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("lpep_dropoff_datetime"),
        "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID",
        "passenger_count", "trip_distance", "fare_amount",
        "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
        _raw_total().alias("total_amount"),
        "payment_type", "trip_type", "congestion_surcharge", "cbd_congestion_fee",
        "file_year", "file_month", *IDENTITY, *_arranged(t))


# -- landed raw files ----------------------------------------------------------------

FLAVOUR_VEHICLE = {"a": spec.VEHICLES[0], "b": spec.VEHICLES[1]}
# Landing folders sit below a folder whose name looks like a month, so every
# read also checks that year / month come from the file name only.
TRAP_FOLDER = "snap-1999-12"
_LANDED: dict[tuple, str] = {}
_SCHEMAS: dict[tuple, object] = {}


def _memo(spark: SparkSession, key: tuple, build) -> str:
    key = (spark.sparkContext.applicationId,) + key
    if key not in _LANDED:
        _LANDED[key] = build()
    return _LANDED[key]


def land_raw(spark: SparkSession, sf_dir: str, flavour: str = "a") -> str:
    """Write the flavour's raw records once per session as monthly raw files
    under the shared checkpoint folder; returns the folder."""
    from farelane.session import scratch_path
    from farelane.sources.files import by_month_file, write_month_files

    def build():
        folder = scratch_path(spark, f"raw-{FLAVOUR_VEHICLE[flavour]}") + "/" + TRAP_FOLDER
        lines = by_month_file(source_lines(spark, sf_dir), FLAVOUR_VEHICLE[flavour])
        df = flavour_a_of(lines) if flavour == "a" else flavour_b_of(lines)
        return write_month_files(df, folder, FLAVOUR_VEHICLE[flavour])
    return _memo(spark, (sf_dir, flavour), build)


def is_landed(spark: SparkSession, sf_dir: str, flavour: str = "a") -> bool:
    """Whether the session has the flavour's raw files already."""
    return (spark.sparkContext.applicationId, sf_dir, flavour) in _LANDED


def remove_landed(spark: SparkSession, sf_dir: str, flavour: str = "a") -> None:
    """Remove the flavour's raw files; the next reader lands them again."""
    from farelane.session import remove_path

    app = spark.sparkContext.applicationId
    if folder := _LANDED.pop((app, sf_dir, flavour), None):
        _SCHEMAS.pop((app, "schema", folder), None)
        remove_path(spark, folder.removesuffix("/" + TRAP_FOLDER))


def read_landed(spark: SparkSession, sf_dir: str, flavour: str = "a") -> DataFrame:
    """Landed raw files of a flavour with file_year / file_month from the file names."""
    from farelane.sources.files import month_glob, read_months, with_file_month

    folder = land_raw(spark, sf_dir, flavour)
    glob = month_glob(folder, FLAVOUR_VEHICLE[flavour])
    key = (spark.sparkContext.applicationId, "schema", folder)
    if key not in _SCHEMAS:  # merge the footers once per landing
        _SCHEMAS[key] = read_months(spark, glob).schema
    return with_file_month(read_months(spark, glob, schema=_SCHEMAS[key]))


# Vintages: (first year, columns changed in files from that year on).
COLUMN_VINTAGE_YEAR = 1998      # from here: cbd_congestion_fee appears, Airport_fee renamed
TYPE_VINTAGE_YEARS = (1997, 1999)  # VendorID int -> bigint; passenger_count int -> bigint -> double


def land_vintages(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Flavour-A raw files whose schema drifts by year.

    ``columns``: before 1998 the airport fee is spelled ``airport_fee`` and
    there is no ``cbd_congestion_fee``; from 1998 both change.  ``types``:
    VendorID is int before 1997 and bigint after; passenger_count is int,
    then bigint (1997-1998), then double (from 1999).
    """
    from farelane.session import remove_path, scratch_path
    from farelane.sources.files import by_month_file, write_month_files

    def build():
        folder, held = scratch_path(spark, f"vintage-{kind}") + "/" + TRAP_FOLDER, scratch_path(spark, "lines")
        lines = source_lines(spark, sf_dir)
        lines.write.parquet(held)  # joined once for all vintages
        lines = spark.read.schema(lines.schema).parquet(held)

        def raw(which) -> DataFrame:
            return flavour_a_of(by_month_file(lines.filter(which), FLAVOUR_VEHICLE["a"]), cbd=kind == "columns")
        y = F.col("file_year").cast("int")
        if kind == "columns":
            old = raw(y < COLUMN_VINTAGE_YEAR).drop("cbd_congestion_fee").withColumnRenamed("Airport_fee", "airport_fee")
            parts = [old, raw(y >= COLUMN_VINTAGE_YEAR)]
        else:
            a, b = TYPE_VINTAGE_YEARS
            parts = [raw(y < a).withColumns({"VendorID": F.col("VendorID").cast("int"),
                                             "passenger_count": F.col("passenger_count").cast("int")}),
                     raw((y >= a) & (y < b)).withColumns({"VendorID": F.col("VendorID").cast("bigint")}),
                     raw(y >= b).withColumns({"VendorID": F.col("VendorID").cast("bigint"),
                                              "passenger_count": F.col("passenger_count").cast("double")})]
        for part in parts:
            write_month_files(part, folder, FLAVOUR_VEHICLE["a"])
        remove_path(spark, held)
        return folder
    return _memo(spark, ("vintage", sf_dir, kind), build)
