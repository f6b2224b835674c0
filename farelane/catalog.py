"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them), so
its work grows with the scale factor.  The matching DuckDB SQL lives in
:data:`ORACLE`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from farelane import oracle as O
from farelane import spec
from farelane.operators import dedup, harmonize
from farelane.plans.curate import curate
from farelane.sources import dims, trips

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapter_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = dims.code_tables(spark)
    d["zone"] = dims.zone_from_nation(spark, sf_dir)
    return d


# -- flagship -------------------------------------------------------------------------

@query("curate_trips", O.curated_sql("a"))
def curate_trips(spark, sf_dir):
    raw = harmonize.harmonize_a(trips.read_landed(spark, sf_dir, "a"))
    return curate(raw, adapter_dims(spark, sf_dir), trips.ADAPTER_COLUMNS)


def curated_by_month(spark, sf_dir):
    """The curated trips, lying by month for a partitioned write."""
    raw = harmonize.harmonize_a(trips.read_landed(spark, sf_dir, "a"))
    return curate(raw, adapter_dims(spark, sf_dir), trips.ADAPTER_COLUMNS, arranged=True)


# -- keep-best / duplicates on lineitem -----------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber")


@query("dedup_keep_best", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) = 1""")
def dedup_keep_best(spark, sf_dir):
    return dedup.keep_best(table(spark, sf_dir, "lineitem"), LINE_KEYS, "l_extendedprice",
                           tiebreak=("l_partkey", "l_suppkey"))


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEYS)


# -- trips adapter helpers ---------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from farelane.operators import clean, enrich, measures, shape  # noqa: E402
from farelane.plans import profile, quality  # noqa: E402
from farelane.plans.curate import curate_columns  # noqa: E402

C = trips.ADAPTER_COLUMNS
IDENT = list(trips.IDENTITY)
ID_SQL = ", ".join(IDENT)


def raw_a(spark, sf_dir):
    """Harmonised flavour-A raw trips read from their landed monthly files."""
    return harmonize.harmonize_a(trips.read_landed(spark, sf_dir, "a"))


def repaired(spark, sf_dir):
    """Raw trips with the total recomputed and timestamps repaired."""
    return clean.repair_timestamps(clean.recompute_total(raw_a(spark, sf_dir), C), C)


def _measured(df, zero_divisor="null"):
    return measures.add_measures(df, C, zero_divisor)


# measures over the repaired chain, for oracle queries
DM_SQL = f"""dm1 AS (SELECT *, {O.DURATION_SQL} AS trip_duration_min FROM d),
dm AS (SELECT *, trip_distance / nullif(trip_duration_min, 0) AS miles_per_minute,
              trip_distance / nullif(trip_duration_min, 0) * 60 AS miles_per_hour,
              fare_amount / nullif(trip_distance, 0) AS fare_amount_per_mile,
              fare_amount / nullif(trip_duration_min, 0) AS fare_amount_per_min FROM dm1)"""
# the same over raw (unrepaired) timestamps
HM_SQL = DM_SQL.replace("FROM d)", "FROM h)").replace("dm1", "hm1").replace("dm AS", "hm AS")


# -- D1, D16 totals ---------------------------------------------------------------------

@query("recompute_total", O.ctes("d") + f"SELECT {ID_SQL}, total_amount FROM d")
def recompute_total(spark, sf_dir):
    return clean.recompute_total(raw_a(spark, sf_dir), C).select(*IDENT, "total_amount")


@query("recompute_total_strict", O.ctes("h") + f"""
SELECT {ID_SQL}, fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge
       + congestion_surcharge + Airport_fee AS total_amount FROM h""")
def recompute_total_strict(spark, sf_dir):
    return clean.recompute_total_strict(raw_a(spark, sf_dir)).select(*IDENT, "total_amount")


# -- D2-D5 timestamps ---------------------------------------------------------------------

@query("repair_year_start", O.ctes("d") + f"SELECT {ID_SQL}, file_year, pickup_datetime FROM d2")
def repair_year_start(spark, sf_dir):
    df = clean.repair_start_year(clean.recompute_total(raw_a(spark, sf_dir), C), C)
    return df.select(*IDENT, "file_year", "pickup_datetime")


@query("repair_year_end", O.ctes("d") + f"SELECT {ID_SQL}, file_year, dropoff_datetime FROM d3")
def repair_year_end(spark, sf_dir):
    df = clean.repair_start_year(clean.recompute_total(raw_a(spark, sf_dir), C), C)
    return clean.repair_end_year(df, C).select(*IDENT, "file_year", "dropoff_datetime")


ORDER_LINES = C.with_(pickup="o_orderdate", dropoff="l_shipdate")


def _order_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")


@query("clamp_end", """
SELECT l_orderkey, l_linenumber, o_orderdate,
       CASE WHEN l_shipdate < o_orderdate THEN o_orderdate ELSE l_shipdate END AS l_shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def clamp_end(spark, sf_dir):
    return clean.clamp_end(_order_lines(spark, sf_dir), ORDER_LINES)


@query("negative_duration", """
SELECT l_orderkey, l_linenumber,
       (epoch(date_trunc('second', l_shipdate)) - epoch(date_trunc('second', o_orderdate))) / 60 AS trip_duration_min
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE (epoch(date_trunc('second', l_shipdate)) - epoch(date_trunc('second', o_orderdate))) / 60 < 0""")
def negative_duration(spark, sf_dir):
    df = measures.add_duration(_order_lines(spark, sf_dir), ORDER_LINES)
    return clean.negative_duration(df).select("l_orderkey", "l_linenumber", "trip_duration_min")


@query("date_parts", O.ctes("d") + f"""
SELECT {ID_SQL},
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year, CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, CAST(year(dropoff_datetime) AS INTEGER) AS dropoff_year,
  CAST(month(dropoff_datetime) AS INTEGER) AS dropoff_month, CAST(day(dropoff_datetime) AS INTEGER) AS dropoff_day
FROM d""")
def date_parts(spark, sf_dir):
    return clean.add_date_parts(repaired(spark, sf_dir), C).select(*IDENT, *clean.DATE_PART_NAMES)


# -- D6-D9 imputation ----------------------------------------------------------------------

@query("impute_null_zero", O.ctes("h") + f"""
SELECT {ID_SQL}, CASE WHEN passenger_count IS NULL OR passenger_count = 0 THEN 1 ELSE passenger_count END
       AS passenger_count FROM h""")
def impute_null_zero(spark, sf_dir):
    return clean.impute_passengers(raw_a(spark, sf_dir), C).select(*IDENT, "passenger_count")


@query("impute_numeric", O.ctes("h") + f"""
SELECT {ID_SQL}, {", ".join(f"coalesce({x}, 0) AS {x}" for x in O.ZERO_FILLED)} FROM h""")
def impute_numeric(spark, sf_dir):
    return clean.impute_zero(raw_a(spark, sf_dir), C).select(*IDENT, *C.zero_fill)


@query("impute_codes", O.ctes("h") + f"""
SELECT {ID_SQL}, {", ".join(f"coalesce({k}, {v}) AS {k}" for k, v in O.CODE_FILLED.items())} FROM h""")
def impute_codes(spark, sf_dir):
    return clean.impute_codes(raw_a(spark, sf_dir), C).select(*IDENT, *C.code_defaults)


_FILL_SQL = "make_timestamp(TRY_CAST(file_year AS INTEGER), TRY_CAST(file_month AS INTEGER), 1, 0, 0, 0.0)"


@query("impute_timestamp", O.ctes("h") + f"""
SELECT {ID_SQL}, coalesce(pickup_datetime, {_FILL_SQL}) AS pickup_datetime,
       coalesce(dropoff_datetime, {_FILL_SQL}) AS dropoff_datetime FROM h""")
def impute_timestamp(spark, sf_dir):
    return clean.impute_timestamps(raw_a(spark, sf_dir), C).select(*IDENT, "pickup_datetime", "dropoff_datetime")


# -- D10-D15 measures and flags --------------------------------------------------------------

@query("duration_minutes", O.ctes("d", extra=DM_SQL) + f"SELECT {ID_SQL}, trip_duration_min FROM dm")
def duration_minutes(spark, sf_dir):
    return measures.add_duration(repaired(spark, sf_dir), C).select(*IDENT, "trip_duration_min")


RATIOS = ["miles_per_minute", "miles_per_hour", "fare_amount_per_mile", "fare_amount_per_min"]


@query("safe_ratios", O.ctes("d", extra=DM_SQL) + f"SELECT {ID_SQL}, {', '.join(RATIOS)} FROM dm")
def safe_ratios(spark, sf_dir):
    return _measured(repaired(spark, sf_dir)).select(*IDENT, *RATIOS)


@query("safe_ratios_zero", O.ctes("d", extra=DM_SQL) + f"""
SELECT {ID_SQL}, coalesce(trip_distance / nullif(trip_duration_min, 0), 0) AS miles_per_minute,
       coalesce(trip_distance / nullif(trip_duration_min, 0), 0) * 60 AS miles_per_hour,
       coalesce(fare_amount / nullif(trip_distance, 0), 0) AS fare_amount_per_mile,
       coalesce(fare_amount / nullif(trip_duration_min, 0), 0) AS fare_amount_per_min FROM dm""")
def safe_ratios_zero(spark, sf_dir):
    return _measured(repaired(spark, sf_dir), "zero").select(*IDENT, *RATIOS)


TRIP_FLAG_SQL = """CASE WHEN miles_per_minute < 0.01 OR miles_per_minute > 2 THEN TRUE
     WHEN trip_distance > 100 AND trip_duration_min < 60 THEN TRUE
     WHEN trip_distance < 20 AND trip_duration_min > 240 THEN TRUE
     WHEN trip_distance < 50 AND trip_duration_min > 480 THEN TRUE
     WHEN trip_distance < 100 AND trip_duration_min > 720 THEN TRUE ELSE FALSE END"""
FARE_FLAG_SQL = """CASE WHEN fare_amount_per_mile < 0 OR fare_amount_per_mile > 30 THEN TRUE
     WHEN fare_amount_per_min < 0 OR fare_amount_per_min > 15 THEN TRUE
     WHEN fare_amount_per_min = 0 THEN TRUE ELSE FALSE END"""


@query("flag_trip_outlier", O.ctes("d", extra=DM_SQL) + f"SELECT {ID_SQL}, {TRIP_FLAG_SQL} AS trip_outlier_flag FROM dm")
def flag_trip_outlier(spark, sf_dir):
    return measures.flag_trip_outlier(_measured(repaired(spark, sf_dir)), C).select(*IDENT, "trip_outlier_flag")


@query("flag_fare_outlier", O.ctes("d", extra=DM_SQL) + f"SELECT {ID_SQL}, {FARE_FLAG_SQL} AS fare_amount_outlier_flag FROM dm")
def flag_fare_outlier(spark, sf_dir):
    return measures.flag_fare_outlier(_measured(repaired(spark, sf_dir))).select(*IDENT, "fare_amount_outlier_flag")


# -- F1-F8 filters -------------------------------------------------------------------------------

@query("filter_non_negative", O.ctes("d") + f"""
SELECT {ID_SQL} FROM d WHERE trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0""")
def filter_non_negative(spark, sf_dir):
    return clean.filter_non_negative(clean.recompute_total(raw_a(spark, sf_dir), C), C).select(*IDENT)


@query("filter_both_zero", O.ctes("d") + f"SELECT {ID_SQL} FROM d WHERE trip_distance > 0 OR total_amount > 0")
def filter_both_zero(spark, sf_dir):
    return clean.filter_both_zero(clean.recompute_total(raw_a(spark, sf_dir), C), C).select(*IDENT)


@query("filter_outlier_bands", O.ctes("d", extra=DM_SQL) + f"""
SELECT {ID_SQL} FROM dm
WHERE miles_per_minute <= 2 AND miles_per_minute >= 0.01
  AND NOT (trip_distance > 100 AND trip_duration_min < 60)
  AND NOT (trip_distance < 20 AND trip_duration_min > 240)
  AND NOT (trip_distance < 50 AND trip_duration_min > 480)
  AND NOT (trip_distance < 100 AND trip_duration_min > 720)""")
def filter_outlier_bands(spark, sf_dir):
    return clean.filter_outlier_bands(_measured(repaired(spark, sf_dir)), "trip").select(*IDENT)


@query("filter_fare_bands", O.ctes("d", extra=DM_SQL) + f"""
SELECT {ID_SQL} FROM dm
WHERE fare_amount_per_mile <= 30 AND fare_amount_per_mile >= 0
  AND fare_amount_per_min <= 15 AND fare_amount_per_min >= 0""")
def filter_fare_bands(spark, sf_dir):
    return clean.filter_outlier_bands(_measured(repaired(spark, sf_dir)), "fare").select(*IDENT)


POINT = {"l_orderkey": 3, "l_partkey": 793, "l_suppkey": 35, "l_linenumber": 4,
         "l_returnflag": "N", "l_shipdate": "1996-02-06 00:00:00"}


@query("point_lookup", """
SELECT * FROM lineitem WHERE l_orderkey = 3 AND l_partkey = 793 AND l_suppkey = 35 AND l_linenumber = 4
  AND l_returnflag = 'N' AND l_shipdate = TIMESTAMP '1996-02-06 00:00:00'""")
def point_lookup(spark, sf_dir):
    eq = dict(POINT, l_shipdate=F.lit(POINT["l_shipdate"]).cast("timestamp_ntz"))
    return clean.point_lookup(table(spark, sf_dir, "lineitem"), eq)


@query("exception_rows", """
SELECT * FROM lineitem WHERE l_discount = 0 AND l_quantity <> 0 AND l_linenumber NOT IN (3, 4)""")
def exception_rows(spark, sf_dir):
    return clean.exception_rows(table(spark, sf_dir, "lineitem"), "l_discount", "l_quantity", "l_linenumber", (3, 4))


@query("null_presence", O.ctes("h") + f"SELECT {ID_SQL}, passenger_count FROM h WHERE passenger_count IS NULL")
def null_presence(spark, sf_dir):
    return clean.null_rows(raw_a(spark, sf_dir), "passenger_count").select(*IDENT, "passenger_count")


@query("dropna_rows", O.ctes("h", extra=HM_SQL) + f"""
SELECT {ID_SQL}, miles_per_minute, trip_duration_min, trip_distance FROM hm
WHERE miles_per_minute IS NOT NULL AND trip_duration_min IS NOT NULL AND trip_distance IS NOT NULL""")
def dropna_rows(spark, sf_dir):
    df = _measured(raw_a(spark, sf_dir)).select(*IDENT, "miles_per_minute", "trip_duration_min", "trip_distance")
    return clean.drop_any_null(df, ["miles_per_minute", "trip_duration_min", "trip_distance"])


# -- J1, A1 reversal pairs -------------------------------------------------------------------------

@query("reversal_groups", O.ctes("d") + f"""
SELECT {O.REV_KEYS}, sum(total_amount) AS total_amount_sum, count(*) AS count FROM d
GROUP BY {O.REV_KEYS} HAVING sum(total_amount) = 0 AND count(*) = 2""")
def reversal_groups(spark, sf_dir):
    return dedup.reversal_groups(repaired(spark, sf_dir), C)


@query("reversal_groups_pruned", O.ctes("d") + f"""
SELECT {O.REV_KEYS}, sum(total_amount) AS total_amount_sum, count(*) AS count FROM d
WHERE VendorID IS NOT NULL AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND PULocationID IS NOT NULL
  AND DOLocationID IS NOT NULL AND trip_distance IS NOT NULL
GROUP BY {O.REV_KEYS} HAVING sum(total_amount) = 0 AND count(*) = 2""")
def reversal_groups_pruned(spark, sf_dir):
    """Pairs, with a key filter before the shuffle."""
    return dedup.reversal_groups(dedup.pair_candidates(repaired(spark, sf_dir), C), C)


@query("reversal_anti_join", O.ctes("k") + f"SELECT {ID_SQL} FROM j1")
def reversal_anti_join(spark, sf_dir):
    return dedup.remove_reversals(repaired(spark, sf_dir), C).select(*IDENT)


# -- J2, J3 lookups --------------------------------------------------------------------------------

@query("lookup_left_join", O.ctes("h") + f"""
SELECT {ID_SQL}, h.RatecodeID, rc.RatecodeDesc, h.payment_type, pt.payment_type_desc
FROM h LEFT JOIN {O.RATECODE_SQL} ON h.RatecodeID = rc.RatecodeID
       LEFT JOIN {O.PAYMENT_SQL} ON h.payment_type = pt.payment_type""")
def lookup_left_join(spark, sf_dir):
    d = dims.code_tables(spark)
    df = enrich.lookup_join(raw_a(spark, sf_dir), d["ratecode"], "RatecodeID")
    df = enrich.lookup_join(df, d["payment_type"], "payment_type")
    return df.select(*IDENT, "RatecodeID", "RatecodeDesc", "payment_type", "payment_type_desc")


@query("lookup_trip_type", O.ctes("h", flavour="b") + f"""
SELECT {ID_SQL}, h.trip_type, tt.trip_type_desc FROM h LEFT JOIN {O.TRIP_TYPE_SQL} ON h.trip_type = tt.trip_type""")
def lookup_trip_type(spark, sf_dir):
    raw = harmonize.harmonize_b(trips.read_landed(spark, sf_dir, "b"))
    df = enrich.lookup_join(raw, dims.code_tables(spark)["trip_type"], "trip_type")
    return df.select(*IDENT, "trip_type", "trip_type_desc")


ZONE_OUT = ["PULocationID", "PU_Borough", "PU_Zone", "PU_service_zone",
            "DOLocationID", "DO_Borough", "DO_Zone", "DO_service_zone"]


@query("role_playing_join", O.ctes("h") + f"""
SELECT {ID_SQL}, PULocationID, pu.Borough AS PU_Borough, pu.Zone AS PU_Zone, pu.service_zone AS PU_service_zone,
       DOLocationID, dz.Borough AS DO_Borough, dz.Zone AS DO_Zone, dz.service_zone AS DO_service_zone
FROM h LEFT JOIN {O.ZONE_SQL} pu ON h.PULocationID = pu.LocationID
       LEFT JOIN {O.ZONE_SQL} dz ON h.DOLocationID = dz.LocationID""")
def role_playing_join(spark, sf_dir):
    zone = dims.zone_from_nation(spark, sf_dir)
    df = enrich.role_join(raw_a(spark, sf_dir), zone, "PULocationID", "LocationID", "PU_")
    df = enrich.role_join(df, zone, "DOLocationID", "LocationID", "DO_")
    return df.select(*IDENT, *ZONE_OUT)


# -- P1-P5 shaping ----------------------------------------------------------------------------------

@query("harmonize_a", O.ctes("h", flavour="a") + "SELECT * FROM h")
def harmonize_a(spark, sf_dir):
    return harmonize.harmonize_a(trips.read_landed(spark, sf_dir, "a"))


@query("harmonize_b", O.ctes("h", flavour="b") + "SELECT * FROM h")
def harmonize_b(spark, sf_dir):
    return harmonize.harmonize_b(trips.read_landed(spark, sf_dir, "b"))


@query("rename_reorder", O.curated_sql("a"))
def rename_reorder(spark, sf_dir):
    return shape.rename_reorder(curate_columns(raw_a(spark, sf_dir), adapter_dims(spark, sf_dir), C))


@query("cast_table", O.curated_sql("a"))
def cast_table(spark, sf_dir):
    text = curate_trips(spark, sf_dir)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    return shape.cast_layout(text)


# -- A3-A6 profiles, L2 / L3 ------------------------------------------------------------------------

@query("distinct_years", O.ctes("h") + "SELECT DISTINCT CAST(year(pickup_datetime) AS INTEGER) AS pickup_year FROM h")
def distinct_years(spark, sf_dir):
    return profile.distinct_values(raw_a(spark, sf_dir), F.year("pickup_datetime").alias("pickup_year"))


PROFILE_COLUMNS = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount"]
_CHECK_SQL = {"zero": "{c} = 0", "negative": "{c} < 0", "null": "{c} IS NULL"}


@query("profile_zero_neg_null", O.ctes("h") + "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {_CHECK_SQL[k].format(c=c)}) AS {k}_{c}"
    for c in PROFILE_COLUMNS for k in ("zero", "negative", "null")) + " FROM h")
def profile_zero_neg_null(spark, sf_dir):
    return profile.profile_wide(raw_a(spark, sf_dir), PROFILE_COLUMNS)


LONG_COLUMNS = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]


@query("profile_long", O.ctes("h") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS \"check\", count(*) FILTER (WHERE {_CHECK_SQL[k].format(c=c)}) AS bad_rows FROM h"
    for c in LONG_COLUMNS for k in ("negative", "zero")))
def profile_long(spark, sf_dir):
    return profile.profile_long(raw_a(spark, sf_dir), LONG_COLUMNS, ("negative", "zero"))


def _boxplot_sql(source: str, groups: list[str], value: str) -> str:
    g = ", ".join(groups)
    on = " AND ".join(f"s.{x} IS NOT DISTINCT FROM b.{x}" for x in groups)
    same = " AND ".join(f"c.{x} IS NOT DISTINCT FROM b.{x}" for x in groups)
    r = lambda e, a: f"round({e}, 4) AS {a}"
    return f"""
q AS (SELECT {g}, count({value}) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
             quantile_cont({value}, 0.75) AS q3 FROM {source} WHERE {value} IS NOT NULL GROUP BY {g}),
b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
c AS (SELECT {', '.join('b.' + x for x in groups)}, min(s.{value}) AS mn, max(s.{value}) AS mx,
             count(*) FILTER (WHERE s.{value} < b.lower_fence OR s.{value} > b.upper_fence) AS n_outliers
      FROM {source} s JOIN b ON {on} GROUP BY {', '.join('b.' + x for x in groups)})
SELECT {', '.join('b.' + x for x in groups)}, n, {r('mn', 'min')}, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')},
       {r('mx', 'max')}, {r('iqr', 'iqr')}, {r('lower_fence', 'lower_fence')}, {r('upper_fence', 'upper_fence')}, n_outliers
FROM b JOIN c ON {same}"""


@query("boxplot_stats", """WITH ev AS (SELECT nullif(event_type, 'click') AS event_type,
  CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE value END AS value FROM events),""" + _boxplot_sql("ev", ["event_type"], "value"))
def boxplot_stats(spark, sf_dir):
    """With a NULL group (clicks) and a hot value (a third of the rows)."""
    ev = table(spark, sf_dir, "events").select(
        F.nullif(F.col("event_type"), F.lit("click")).alias("event_type"),
        F.when(F.col("event_id") % 3 == 0, F.lit(1.0)).otherwise(F.col("value")).alias("value"))
    return profile.boxplot_stats(ev, ["event_type"], "value")


_BAND_SQL = """miles_per_minute <= 2 AND miles_per_minute >= 0.01
  AND NOT (trip_distance > 100 AND trip_duration_min < 60) AND NOT (trip_distance < 20 AND trip_duration_min > 240)
  AND NOT (trip_distance < 50 AND trip_duration_min > 480) AND NOT (trip_distance < 100 AND trip_duration_min > 720)"""
_MEASURE_NAMES = ["miles_per_minute", "trip_duration_min", "trip_distance"]


@query("boxplot_before_after", O.ctes("h", extra=HM_SQL + ",\n" + f"""
nn AS (SELECT * FROM hm WHERE miles_per_minute IS NOT NULL AND trip_duration_min IS NOT NULL AND trip_distance IS NOT NULL),
staged AS (SELECT 'before' AS stage, * FROM nn UNION ALL SELECT 'after' AS stage, * FROM nn WHERE {_BAND_SQL}),
lng AS ({' UNION ALL '.join(f"SELECT stage, '{m}' AS measure, {m} AS value FROM staged" for m in _MEASURE_NAMES)}),"""
                                                  + _boxplot_sql("lng", ["stage", "measure"], "value")))
def boxplot_before_after(spark, sf_dir):
    m = clean.drop_any_null(_measured(raw_a(spark, sf_dir)), _MEASURE_NAMES)
    return profile.boxplot_stats(_staged(m, "trip", _MEASURE_NAMES), ["stage", "measure"], "value")


def _staged(m, band: str, names: list[str]):
    """Long rows (stage, measure, value): every row 'before', those inside the
    band 'after' too.  One scan: a row is multiplied, not read again."""
    inside = clean.trip_band() if band == "trip" else clean.fare_band()
    stages = F.when(inside, F.array(F.lit("before"), F.lit("after"))).otherwise(F.array(F.lit("before")))
    return m.select(F.explode(stages).alias("stage"), *names).unpivot(["stage"], names, "measure", "value")


_FARE_BAND_SQL = """fare_amount_per_mile <= 30 AND fare_amount_per_mile >= 0
  AND fare_amount_per_min <= 15 AND fare_amount_per_min >= 0"""
_AMOUNT_NAMES = ["fare_amount_per_mile", "fare_amount_per_min", "fare_amount", "total_amount"]


@query("boxplot_amounts", O.ctes("h", extra=HM_SQL + ",\n" + f"""
nn AS (SELECT * FROM hm WHERE {' AND '.join(f"{m} IS NOT NULL" for m in _AMOUNT_NAMES)}),
staged AS (SELECT 'before' AS stage, * FROM nn UNION ALL SELECT 'after' AS stage, * FROM nn WHERE {_FARE_BAND_SQL}),
lng AS ({' UNION ALL '.join(f"SELECT stage, '{m}' AS measure, {m} AS value FROM staged" for m in _AMOUNT_NAMES)}),"""
                                             + _boxplot_sql("lng", ["stage", "measure"], "value")))
def boxplot_amounts(spark, sf_dir):
    """The four amounts before and after the fare band."""
    m = clean.drop_any_null(_measured(raw_a(spark, sf_dir)), _AMOUNT_NAMES)
    return profile.boxplot_stats(_staged(m, "fare", _AMOUNT_NAMES), ["stage", "measure"], "value")


@query("preview_top5", O.ctes("h") + f"""
SELECT {ID_SQL}, fare_amount FROM h WHERE fare_amount < 0 ORDER BY {ID_SQL} LIMIT 5""")
def preview_top5(spark, sf_dir):
    neg = raw_a(spark, sf_dir).filter(F.col("fare_amount") < 0)
    return profile.preview(neg, IDENT, 5).select(*IDENT, "fare_amount")


@query("sample_rows", """
SELECT * FROM events WHERE CAST('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 1""")
def sample_rows(spark, sf_dir):
    return profile.sample_rows(table(spark, sf_dir, "events"), ["event_id"], 1, seed=42)


# -- Q0-Q6 quality ----------------------------------------------------------------------------------

def _quality_sql() -> str:
    meta = [(check, c, 0) for check in ("column_present", "column_type") for c in O.CURATED_NAMES]
    values = ", ".join(f"('{a}', '{b}', {n})" for a, b, n in meta)
    checks = [("zero", c, f"{c} = 0") for c in O.NOT_ZERO]
    checks += [("negative", c, f"{c} < 0") for c in O.NOT_NEGATIVE]
    checks += [("null", c, f"{c} IS NULL") for c in O.NOT_NULL]
    counts = "\nUNION ALL ".join(f"SELECT '{a}', '{b}', count(*) FILTER (WHERE {p}) FROM cur" for a, b, p in checks)
    keys = ", ".join(O.UNIQUE_KEY)
    dup = (f"SELECT 'duplicate_key', '{','.join(O.UNIQUE_KEY)}', count(*) FROM "
           f"(SELECT {keys} FROM cur GROUP BY {keys} HAVING count(*) > 1)")
    return (O.ctes("cur") + f"""SELECT "check", "column", CAST(bad_rows AS BIGINT) AS bad_rows FROM (
SELECT * FROM (VALUES {values}) AS v("check", "column", bad_rows)
UNION ALL {counts}
UNION ALL {dup})""")


@query("quality_report", _quality_sql())
def quality_report(spark, sf_dir):
    return quality.quality_report(curate_trips(spark, sf_dir))


def _broken_sql() -> str:
    """The report of a frame without airport_fee, with text totals and some
    distances negated."""
    bad = {("column_present", "airport_fee"), ("column_type", "airport_fee"), ("column_type", "total_amount")}
    values = ", ".join(f"('{k}', '{c}', {int((k, c) in bad)})" for k in ("column_present", "column_type") for c in O.CURATED_NAMES)
    return O.ctes("cur") + f"""SELECT "check", "column", CAST(bad_rows AS BIGINT) AS bad_rows FROM (
SELECT * FROM (VALUES {values}) AS v("check", "column", bad_rows)
UNION ALL SELECT 'negative', 'trip_distance', count(*) FILTER (WHERE trip_distance > 10) FROM cur)"""


@query("quality_schema", _broken_sql())
def quality_schema(spark, sf_dir):
    """Schema checks, and one row check, on a deliberately broken frame."""
    broken = (curate_trips(spark, sf_dir).drop("airport_fee")
              .withColumns({"total_amount": F.col("total_amount").cast("string"),
                            "trip_distance": F.when(F.col("trip_distance") > 10, -F.col("trip_distance")).otherwise(F.col("trip_distance"))}))
    report = quality.quality_report(broken)
    return report.where("check LIKE 'column%' OR (check = 'negative' AND column = 'trip_distance')")


# -- S1-S9 scans, run modes, calendar ----------------------------------------------------------------


from farelane.session import scratch_path, staged, staging  # noqa: E402
from farelane.sinks import parquet as sink  # noqa: E402
from farelane.sources import calendar, files, runmodes  # noqa: E402

VEHICLE_A = trips.FLAVOUR_VEHICLE["a"]
SEL_SQL = f"SELECT {ID_SQL}, file_year, file_month FROM raw"


@query("scan_merge_schema", O.ctes("h", flavour="v") + f"""
SELECT {ID_SQL}, file_year, file_month, Airport_fee AS airport_fee, cbd_congestion_fee FROM h""")
def scan_merge_schema(spark, sf_dir):
    folder = trips.land_vintages(spark, sf_dir, "columns")
    df = files.with_file_month(files.read_months(spark, files.month_glob(folder, VEHICLE_A)))
    return df.select(*IDENT, "file_year", "file_month", F.col("airport_fee").alias("airport_fee"),
                     "cbd_congestion_fee")


@query("curate_vintages", O.curated_sql("v"))
def curate_vintages(spark, sf_dir):
    """Files that spell the airport fee in two ways and gain a column, curated."""
    folder = trips.land_vintages(spark, sf_dir, "columns")
    raw = runmodes.select_months(spark, folder, VEHICLE_A, "full_load")
    return curate(harmonize.harmonize_a(raw), adapter_dims(spark, sf_dir), C)


@query("curate_type_vintages", O.curated_sql("a"))
def curate_type_vintages(spark, sf_dir):
    """Files whose column types drift, curated."""
    folder = trips.land_vintages(spark, sf_dir, "types")
    raw = runmodes.select_months(spark, folder, VEHICLE_A, "full_load")
    return curate(harmonize.harmonize_a(raw), adapter_dims(spark, sf_dir), C)


@query("schema_reconcile", O.ctes("raw") + f"""
SELECT {ID_SQL}, file_year, file_month, CAST(VendorID AS BIGINT) AS VendorID,
       CAST(passenger_count AS DOUBLE) AS passenger_count FROM raw""")
def schema_reconcile(spark, sf_dir):
    folder = trips.land_vintages(spark, sf_dir, "types")
    df = files.read_reconciled(spark, files.month_glob(folder, VEHICLE_A))
    return df.select(*IDENT, "file_year", "file_month", "VendorID", "passenger_count")


@query("glob_scan_rowcount", O.ctes("raw") + "SELECT count(*) AS n_rows FROM raw WHERE file_year = '1996'")
def glob_scan_rowcount(spark, sf_dir):
    folder = trips.land_raw(spark, sf_dir, "a")
    return files.read_months(spark, files.month_glob(folder, VEHICLE_A, "1996")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("file_year_month", O.ctes("raw") + SEL_SQL)
def file_year_month(spark, sf_dir):
    return trips.read_landed(spark, sf_dir, "a").select(*IDENT, "file_year", "file_month")


def _selected(spark, sf_dir, mode, months=0, minimum=None):
    folder = trips.land_raw(spark, sf_dir, "a")
    kw = {} if minimum is None else {"minimum": minimum}
    return runmodes.select_months(spark, folder, VEHICLE_A, mode, months, **kw).select(
        *IDENT, "file_year", "file_month")


@query("select_full_load", O.ctes("raw") + SEL_SQL)
def select_full_load(spark, sf_dir):
    return _selected(spark, sf_dir, "full_load")


@query("select_past_months", O.ctes("raw", extra="""lastm AS (
  SELECT DISTINCT file_year, file_month FROM raw ORDER BY file_year DESC, file_month DESC LIMIT 3)""") + SEL_SQL
       + " WHERE EXISTS (SELECT 1 FROM lastm l WHERE l.file_year = raw.file_year AND l.file_month = raw.file_month)")
def select_past_months(spark, sf_dir):
    return _selected(spark, sf_dir, "past_months", 3)


# The test tables start in 1992, so the month floor is a parameter here.
SPECIFIC_MONTH, SPECIFIC_MONTH_FLOOR = 199801, 199200


@query("select_specific_month", O.ctes("raw") + SEL_SQL + " WHERE file_year = '1998' AND file_month = '01'")
def select_specific_month(spark, sf_dir):
    return _selected(spark, sf_dir, "specific_month", SPECIFIC_MONTH, SPECIFIC_MONTH_FLOOR)


def _bounds(spark, sf_dir):
    """First year and the 'today' of the data set (latest order date)."""
    return table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("first_year"),
                                              F.max("o_orderdate").alias("as_of"))


_BOUNDS_SQL = """b AS (SELECT min(year(o_orderdate)) AS first_year,
                year(max(o_orderdate) - INTERVAL 2 MONTH) AS last_year FROM orders)"""


@query("publication_horizon", "WITH " + _BOUNDS_SQL + """
SELECT CAST(unnest(generate_series(first_year, last_year)) AS INTEGER) AS year FROM b""")
def publication_horizon(spark, sf_dir):
    return calendar.publication_years(_bounds(spark, sf_dir))


@query("missing_months", O.ctes("raw", extra=_BOUNDS_SQL + """,
ys AS (SELECT unnest(generate_series(first_year, last_year)) AS year FROM b),
vs AS (SELECT unnest(['yellow', 'green', 'fhv', 'fhvhv']) AS vehicle),
ms AS (SELECT unnest(generate_series(1, 12)) AS month),
exp AS (SELECT vehicle, year, month FROM vs CROSS JOIN ys CROSS JOIN ms),
obs AS (SELECT DISTINCT v.vehicle, CAST(file_year AS INTEGER) AS year, CAST(file_month AS INTEGER) AS month
        FROM raw CROSS JOIN (VALUES ('yellow'), ('green')) AS v(vehicle))""") + """
SELECT vehicle, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM exp e
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.vehicle = e.vehicle AND o.year = e.year AND o.month = e.month)""")
def missing_months(spark, sf_dir):
    expected = calendar.expected_months(_bounds(spark, sf_dir))
    observed = None
    for flavour, vehicle in trips.FLAVOUR_VEHICLE.items():
        listing = files.file_listing(spark, files.month_glob(trips.land_raw(spark, sf_dir, flavour), vehicle))
        seen = files.listed_months(listing).select(
            F.lit(vehicle).alias("vehicle"), F.col("file_year").cast("int").alias("year"),
            F.col("file_month").cast("int").alias("month"))
        observed = seen if observed is None else observed.unionByName(seen)
    return calendar.missing_months(expected, observed)


CUSTOMER_CSV_SCHEMA = "c_custkey bigint, c_name string, c_segment string"


@query("csv_dim_scan", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey = 0 THEN 'NA' WHEN c_nationkey = 4 THEN 'N/A'
                               ELSE c_mktsegment END AS c_segment
FROM customer""")
def csv_dim_scan(spark, sf_dir):
    """Customer rows written as lookup CSV files (blank after commas, quoted
    strings, trailing comma, CRLF, 'NA' / 'N/A' strings) and read back."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_nationkey") == 0, F.lit("NA")).when(F.col("c_nationkey") == 4, F.lit("N/A"))
         .otherwise(F.col("c_mktsegment")).alias("c_segment"))
    path = dims.write_lookup_csv(cust, scratch_path(spark, "lookup-csv"))
    return dims.read_csv_dim(spark, path, CUSTOMER_CSV_SCHEMA)


def lookup_folder(spark, sf_dir) -> str:
    """The four lookup tables written as CSV files in the hand-edited style."""
    folder = scratch_path(spark, "lookups")
    codes = dims.code_tables(spark)
    for name in ("payment_type", "ratecode", "trip_type"):
        dims.write_lookup_csv(codes[name], f"{folder}/{name}.csv", quote_strings=False, trailing_sep=name == "ratecode")
    dims.write_lookup_csv(dims.zone_from_nation(spark, sf_dir), f"{folder}/taxi_zone.csv")
    return folder


@query("curate_csv_lookups", O.ctes("cur") + """SELECT c.*, tt.trip_type_desc FROM (
  SELECT cur.*, 3 AS trip_type FROM cur) c LEFT JOIN """ + O.TRIP_TYPE_SQL + " ON c.trip_type = tt.trip_type")
def curate_csv_lookups(spark, sf_dir):
    """The curated trips with all four lookups read from their CSV files."""
    t = dims.read_lookup_folder(spark, lookup_folder(spark, sf_dir))
    tables = {"ratecode": t["ratecode"], "payment_type": t["payment_type"], "zone": t["taxi_zone"]}
    wide = enrich.lookup_join(curate_columns(raw_a(spark, sf_dir), tables, C), t["trip_type"], "trip_type")
    layout = (*spec.CURATED_COLUMNS, ("trip_type", "trip_type", "int"), ("trip_type_desc", "trip_type_desc", "string"))
    return shape.to_curated(wide, layout)


# -- S5, S6 curated table ----------------------------------------------------------------------------

def _curated_table(spark, sf_dir) -> str:
    def build():
        path = scratch_path(spark, "curated")
        sink.write_partitioned(curated_by_month(spark, sf_dir), path, arranged=True)
        return path
    return trips._memo(spark, ("curated", sf_dir), build)


@query("partition_pruned_read", O.ctes("cur") + "SELECT * FROM cur WHERE file_year = '1998' AND file_month = '01'")
def partition_pruned_read(spark, sf_dir):
    return files.read_partitioned(spark, _curated_table(spark, sf_dir), files.curated_schema(),
                                  where="file_year = '1998' AND file_month = '01'")


@query("dynamic_overwrite_roundtrip", O.ctes("cur", extra="""lastm AS (
  SELECT DISTINCT file_year, file_month FROM cur ORDER BY file_year DESC, file_month DESC LIMIT 3)""") + """
SELECT * FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM lastm l WHERE l.file_year = c.file_year AND l.file_month = c.file_month)
   OR store_and_fwd_flag = 'Y'""")
def dynamic_overwrite_roundtrip(spark, sf_dir):
    """Full load, then a re-run of the last three months (here: only their
    'Y' rows) replaces exactly those months and leaves the others as they were."""
    target = scratch_path(spark, "curated-roundtrip")
    sink.write_partitioned(curated_by_month(spark, sf_dir), target, arranged=True)
    loaded = files.read_partitioned(spark, target, files.curated_schema())
    last3 = loaded.select("file_year", "file_month").distinct().orderBy(
        F.col("file_year").desc(), F.col("file_month").desc()).limit(3)
    rerun = staged(loaded.join(last3, ["file_year", "file_month"], "left_semi")
                   .filter(F.col("store_and_fwd_flag") == "Y")
                   .select(*loaded.columns), "rerun")  # cut the read of target before overwriting it
    sink.write_partitioned(rerun, target)
    return files.read_partitioned(spark, target, files.curated_schema())


# -- C2-C4 flavour jobs ------------------------------------------------------------------------------

HARMONIZE = {"a": harmonize.harmonize_a, "b": harmonize.harmonize_b}


def publish_flavour(spark, sf_dir, flavour: str, target: str, strict: bool = True) -> list:
    """read landed raw -> harmonise -> curate -> quality gate -> month replacement."""
    with staging(spark):
        raw = HARMONIZE[flavour](trips.read_landed(spark, sf_dir, flavour))
        cur = curate(raw, adapter_dims(spark, sf_dir), C, arranged=True)
        return sink.gated_publish(cur, target, strict=strict, arranged=True)


def _published(spark, sf_dir, flavour):
    target = scratch_path(spark, f"curated-{trips.FLAVOUR_VEHICLE[flavour]}")
    publish_flavour(spark, sf_dir, flavour, target)
    return files.read_partitioned(spark, target, files.curated_schema())


@query("curate_flavour_a", O.curated_sql("a"))
def curate_flavour_a(spark, sf_dir):
    return _published(spark, sf_dir, "a")


@query("curate_flavour_b", O.curated_sql("b"))
def curate_flavour_b(spark, sf_dir):
    return _published(spark, sf_dir, "b")


@query("curate_both", f"""
SELECT 'green' AS vehicle, * FROM ({O.curated_sql("b")})
UNION ALL
SELECT 'yellow' AS vehicle, * FROM ({O.curated_sql("a")})""")
def curate_both(spark, sf_dir):
    out = None
    for flavour in ("b", "a"):  # same order as the job dispatcher: green, then yellow
        landed = trips.is_landed(spark, sf_dir, flavour)
        df = _published(spark, sf_dir, flavour)
        if not landed:  # the published table reads none of it
            trips.remove_landed(spark, sf_dir, flavour)
        df = df.select(F.lit(trips.FLAVOUR_VEHICLE[flavour]).alias("vehicle"), *df.columns)
        out = df if out is None else out.unionByName(df)
    return out


# -- streaming -------------------------------------------------------------------------------------

from farelane.streaming import incremental  # noqa: E402


@query("curate_incremental", O.curated_sql("a"))
def curate_incremental(spark, sf_dir):
    """File-stream run over the landed raw files (several micro-batches),
    each rebuilding and publishing the months it touched."""
    folder = trips.land_raw(spark, sf_dir, "a")
    target = scratch_path(spark, "curated-stream")
    dims_ = adapter_dims(spark, sf_dir)
    incremental.run_incremental(
        spark, folder, VEHICLE_A, target, scratch_path(spark, "stream-ckpt"),
        lambda raw, cols: curate(harmonize.harmonize_a(raw), dims_, cols, arranged=True), C, files_per_batch=40, strict=True, arranged=True)
    return files.read_partitioned(spark, target, files.curated_schema())


# -- files that change, and pairs across months -----------------------------------------------------

from farelane.streaming import corrections  # noqa: E402

CORRECTED_SQL = """raw2 AS (SELECT * REPLACE (CASE WHEN file_year = '1996' AND file_month = '03' THEN fare_amount + 1 ELSE fare_amount END AS fare_amount)
  FROM raw WHERE NOT (file_year = '1996' AND file_month = '03' AND l_orderkey % 2 = 1)),"""
LATE_COPIES_SQL = """raw2 AS (SELECT * REPLACE (CASE WHEN copy_no > 0 AND file_month < '12' THEN lpad(CAST(CAST(file_month AS INTEGER) + 1 AS VARCHAR), 2, '0')
  ELSE file_month END AS file_month) FROM raw),"""


def _from_raw2(sql: str, raw2: str) -> str:
    """The trip chain over other raw rows."""
    return sql.replace("\nh AS (", "\n" + raw2 + "\nh AS (").replace("FROM raw\n)", "FROM raw2\n)")


@query("curate_corrected", _from_raw2(O.curated_sql("a"), CORRECTED_SQL))
def curate_corrected(spark, sf_dir):
    """All months published, then one month landed again under its name with
    rows withdrawn and fares corrected: the next run takes that month alone."""
    folder, target, home = (scratch_path(spark, f"corrected-{x}") for x in ("raw", "table", "home"))
    lines, dims_ = trips.source_lines(spark, sf_dir), adapter_dims(spark, sf_dir)
    land = lambda some, by: files.write_month_files(by(trips.flavour_a_of(files.by_month_file(some, VEHICLE_A))), folder, VEHICLE_A)
    land(lines, lambda raw: raw)
    run = lambda: corrections.run_corrections(
        spark, folder, VEHICLE_A, target, home, harmonize.harmonize_a, dims_, C, strict=True)
    run()
    land(lines.where("file_year = '1996' AND file_month = '03' AND l_orderkey % 2 = 0"), lambda raw: raw.withColumn("fare_amount", F.col("fare_amount") + 1))
    run()
    return files.read_partitioned(spark, target, files.curated_schema())


@query("curate_across_months", _from_raw2(O.curated_sql("a"), LATE_COPIES_SQL))
def curate_across_months(spark, sf_dir):
    """Reversals and copies that come in the next month's file: the run takes
    the months in steps and finds pairs and duplicates as one load would."""
    folder, target, home = (scratch_path(spark, f"across-{x}") for x in ("raw", "table", "home"))
    later = F.lpad((F.col("file_month").cast("int") + 1).cast("string"), 2, "0")
    lines = trips.source_lines(spark, sf_dir).withColumn(
        "file_month", F.when((F.col("copy_no") > 0) & (F.col("file_month") < "12"), later).otherwise(F.col("file_month")))
    files.write_month_files(trips.flavour_a_of(files.by_month_file(lines, VEHICLE_A)), folder, VEHICLE_A)
    corrections.run_corrections(spark, folder, VEHICLE_A, target, home, harmonize.harmonize_a, adapter_dims(spark, sf_dir), C,
                                pair_scope="load", months_per_step=42, strict=True)
    return files.read_partitioned(spark, target, files.curated_schema())


# -- reject channels, clustered lookups, run-time pruning, sketches ------------------------------------

@query("cast_rejects", O.ctes("cur") + """
SELECT * EXCLUDE (bad_fare, bad_time) REPLACE (CASE WHEN bad_fare THEN NULL ELSE fare_amount END AS fare_amount,
                                               CASE WHEN bad_time THEN NULL ELSE pickup_datetime END AS pickup_datetime),
       concat_ws(',', CASE WHEN bad_time THEN 'pickup_datetime' END, CASE WHEN bad_fare THEN 'fare_amount' END) AS failed_columns,
       concat_ws(',', CASE WHEN bad_time THEN '1998-13-01' END, CASE WHEN bad_fare THEN 'n/a' END) AS failed_values,
       CASE WHEN bad_fare OR bad_time THEN 'reject' ELSE 'good' END AS channel
FROM (SELECT *, pu_location_id % 7 = 0 AS bad_fare, do_location_id % 11 = 0 AS bad_time FROM cur)""")
def cast_rejects(spark, sf_dir):
    """The curated table as text with malformed fares and timestamps: both
    outputs of the cast, split by one write."""
    text = files.read_partitioned(spark, _curated_table(spark, sf_dir), files.curated_schema())
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    broken = text.withColumns({
        "fare_amount": F.when(F.col("pu_location_id").cast("int") % 7 == 0, "n/a").otherwise(F.col("fare_amount")),
        "pickup_datetime": F.when(F.col("do_location_id").cast("int") % 11 == 0, "1998-13-01").otherwise(F.col("pickup_datetime"))})
    path = scratch_path(spark, "cast")
    shape.cast_or_reject(broken).withColumn("channel", F.when(shape.is_reject(), "reject").otherwise("good")).write.partitionBy("channel").parquet(path)
    joined = lambda c: F.concat_ws(",", c).alias(c)
    return spark.read.parquet(path).select(*text.columns, joined("failed_columns"), joined("failed_values"), "channel")


REJECT_KINDS = """CASE c_custkey % 40 WHEN 1 THEN 'unclosed quote' WHEN 2 THEN 'too few fields' WHEN 3 THEN 'too many fields'
  WHEN 4 THEN 'bad c_custkey' WHEN 5 THEN 'no key' WHEN 6 THEN 'doubled key' ELSE 'good' END"""


@query("lookup_rejects", f"""
WITH k AS (SELECT c_custkey, c_name, {REJECT_KINDS} AS finding FROM customer)
SELECT finding, CASE WHEN finding = 'doubled key' THEN c_custkey END AS c_custkey,
       CASE finding WHEN 'unclosed quote' THEN c_custkey || ', "' || c_name || ', x,' WHEN 'too few fields' THEN CAST(c_custkey AS VARCHAR)
                    WHEN 'too many fields' THEN c_custkey || ', "' || c_name || '", x, more,' WHEN 'bad c_custkey' THEN 'k' || c_custkey || ', "' || c_name || '", x,'
                    WHEN 'no key' THEN ', "' || c_name || '", x,' END AS line,
       CAST(CASE WHEN finding = 'doubled key' THEN 2 ELSE 1 END AS BIGINT) AS n
FROM k WHERE finding <> 'good'""")
def lookup_rejects(spark, sf_dir):
    """Customer rows as a hand-edited lookup file with broken lines and
    doubled keys: every rejected line with its reason, every doubled key."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.expr(REJECT_KINDS).alias("kind"))
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    sound = F.concat(key, F.lit(', "'), name, F.lit('", x,'))
    line = (F.when(F.col("kind") == "unclosed quote", F.concat(key, F.lit(', "'), name, F.lit(", x,")))
             .when(F.col("kind") == "too few fields", key)
             .when(F.col("kind") == "too many fields", F.concat(key, F.lit(', "'), name, F.lit('", x, more,')))
             .when(F.col("kind") == "bad c_custkey", F.concat(F.lit("k"), sound))
             .when(F.col("kind") == "no key", F.concat(F.lit(', "'), name, F.lit('", x,'))).otherwise(sound))
    lines = cust.select(F.explode(F.when(F.col("kind") == "doubled key", F.array(line, line)).otherwise(F.array(line))).alias("value"))
    path = scratch_path(spark, "broken-lookup")
    lines.write.text(path)
    rows = dims.read_csv_checked(spark, path, "c_custkey bigint, c_name string, c_segment string", "c_custkey")
    doubled = dims.doubled_keys(rows.where("reason IS NULL"), "c_custkey")
    none = F.lit(None)
    return rows.where("reason IS NOT NULL").select(
        F.col("reason").alias("finding"), none.cast("bigint").alias("c_custkey"), "line", F.lit(1).cast("bigint").alias("n")).unionByName(
        doubled.select(F.lit("doubled key").alias("finding"), "c_custkey", none.cast("string").alias("line"), F.col("count").alias("n")))


def _clustered_table(spark, sf_dir) -> str:
    def build():
        path = scratch_path(spark, "clustered")
        sink.write_clustered(curate_trips(spark, sf_dir), path, ["pu_location_id", "do_location_id", "pickup_datetime"], ["do_location_id"])
        return path
    return trips._memo(spark, ("clustered", sf_dir), build)


@query("point_lookup_clustered", O.ctes("cur") + "SELECT * FROM cur WHERE pu_location_id = 3 AND do_location_id = 5")
def point_lookup_clustered(spark, sf_dir):
    """A trip lookup on the clustered curated table."""
    held = files.read_partitioned(spark, _clustered_table(spark, sf_dir), files.curated_schema())
    return clean.point_lookup(held, {"pu_location_id": 3, "do_location_id": 5})


@query("last_months_pruned", O.ctes("cur", extra="""lastm AS (
  SELECT DISTINCT file_year, file_month FROM cur ORDER BY file_year DESC, file_month DESC LIMIT 3)""") + """
SELECT c.* FROM cur c JOIN lastm USING (file_year, file_month)""")
def last_months_pruned(spark, sf_dir):
    return files.read_last_months(spark, _curated_table(spark, sf_dir), 3, files.curated_schema())


SKETCHED = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


@query("quantile_sketches", O.ctes("cur") + """
SELECT g.payment_type_desc, q.name, g.n, TRUE AS within_error
FROM (SELECT CASE WHEN payment_type <> 5 THEN payment_type_desc END AS payment_type_desc, count(*) AS n FROM cur GROUP BY 1) g,
     (VALUES ('q1'), ('median'), ('q3'), ('p99')) q(name)""")
def quantile_sketches(spark, sf_dir):
    """Fare quantiles of all months from one stored sketch a month and group
    (a NULL group among them), held against the exact ranks."""
    cur = files.read_partitioned(spark, _curated_table(spark, sf_dir), files.curated_schema()).withColumn(
        "payment_type_desc", F.when(F.col("payment_type") != 5, F.col("payment_type_desc")))
    path, groups = scratch_path(spark, "sketches"), ["payment_type_desc"]
    profile.month_sketches(cur, groups, "fare_amount").write.partitionBy("file_year", "file_month").parquet(path)
    merged = profile.sketch_quantiles(spark.read.parquet(path), groups, SKETCHED)
    long = merged.unpivot(["payment_type_desc", "n"], list(SKETCHED), "name", "value")
    of = long.withColumnRenamed("payment_type_desc", "_g")
    ranks = (cur.join(F.broadcast(of), F.col("payment_type_desc").eqNullSafe(F.col("_g")))  # a row a group and quantile
                .groupBy("_g", "name", "n").agg((F.count_if(F.col("fare_amount") < F.col("value")) / F.first("n")).alias("below"),
                                                (F.count_if(F.col("fare_amount") <= F.col("value")) / F.first("n")).alias("upto")))
    wanted = F.element_at(F.create_map(*[x for k, p in SKETCHED.items() for x in (F.lit(k), F.lit(p))]), F.col("name"))
    within = (wanted >= F.col("below") - profile.RANK_ERROR) & (wanted <= F.col("upto") + profile.RANK_ERROR)
    return ranks.select(F.col("_g").alias("payment_type_desc"), "name", "n", within.alias("within_error"))
