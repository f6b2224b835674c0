"""Reversal pairs, keep-best, and fused vs literal curation plan."""
import datetime as dt

from pyspark.sql import functions as F

from farelane.operators import dedup
from comparison_plans import apply as _remove_pairs_and_duplicates
from farelane.spec import DEFAULT_COLUMNS

T0 = dt.datetime(2024, 1, 1, 10, 0)
T1 = dt.datetime(2024, 1, 1, 10, 20)
SCHEMA = ("VendorID int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, "
          "DOLocationID int, trip_distance double, fare_amount double, total_amount double, rid int")
COLS = DEFAULT_COLUMNS.with_(tiebreak=("rid",))


def row(fare, total, rid, pu=1, vendor=1, dist=2.0):
    return (vendor, T0, T1, pu, 2, dist, fare, total, rid)


def kept(df):
    return sorted(r.rid for r in df.collect())


def test_pair_removed_triple_kept_zero_pair_removed_null_key_kept(spark):
    rows = [row(10.0, 12.0, 1), row(-10.0, -12.0, 2),                  # pair -> removed
            row(5.0, 6.0, 3, pu=7), row(-5.0, -6.0, 4, pu=7), row(5.0, 6.0, 5, pu=7),  # triple kept
            row(0.0, 0.0, 6, pu=8), row(0.0, 0.0, 7, pu=8),            # zero pair -> removed
            row(3.0, 4.0, 8, pu=None), row(-3.0, -4.0, 9, pu=None)]    # NULL key -> kept
    df = spark.createDataFrame(rows, SCHEMA)
    assert kept(dedup.remove_reversals(df, COLS)) == [3, 4, 5, 8, 9]


def test_keep_best_prefers_highest_total_then_tiebreak(spark):
    rows = [row(10.0, 12.0, 3), row(10.0, 11.0, 1), row(10.0, 12.0, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert kept(dedup.dedup_trips(df, COLS)) == [2]


def test_fused_plan_equals_literal_plan_with_a_hot_key(spark):
    """A third of the rows share one key (with NULLs and many fares)."""
    base = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("VendorID"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(
            F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 50).cast("int"), F.lit(0))
        ).cast("timestamp_ntz").alias("pickup_datetime"),
        F.lit(T1).cast("timestamp_ntz").alias("dropoff_datetime"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 7).cast("int")).alias("PULocationID"),
        F.lit(2).alias("DOLocationID"),
        (F.col("id") % 4 / 2).alias("trip_distance"),
        ((F.col("id") % 11) - 2).cast("double").alias("fare_amount"),
        ((F.col("id") % 13) - 3).cast("double").alias("total_amount"),
        F.col("id").cast("int").alias("rid"))
    pairs = base.filter(F.col("rid") % 10 == 1).withColumns(
        {"fare_amount": -F.col("fare_amount"), "total_amount": -F.col("total_amount"),
         "rid": F.col("rid") + 100000})
    df = base.unionByName(pairs).repartition(6)
    fused = kept(_remove_pairs_and_duplicates(df, COLS, "fused"))
    literal = kept(_remove_pairs_and_duplicates(df, COLS, "literal"))
    window = kept(_remove_pairs_and_duplicates(df, COLS, "window"))
    single = kept(_remove_pairs_and_duplicates(df, COLS, "single"))
    assert fused == literal == window == single and len(fused) > 0


def test_duplicate_keys_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a int, b int")
    got = sorted(tuple(r) for r in dedup.duplicate_keys(df, ["a", "b"]).collect())
    assert got == [(1, 1, 2), (2, 1, 3)]


def _shuffled_rows(df):
    """Rows written by the exchanges of an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan.finalPhysicalPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().length())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return total


def test_the_key_filter_keeps_groups_whole_and_prunes_the_shuffle(spark):
    base = spark.range(20_000).select(
        F.lit(1).alias("VendorID"), (F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"), F.lit(0))).cast("timestamp_ntz").alias("pickup_datetime"),
        F.lit(T1).cast("timestamp_ntz").alias("dropoff_datetime"), F.when(F.col("id") % 1000 != 7, 3).alias("PULocationID"), F.lit(2).alias("DOLocationID"),
        F.lit(1.5).alias("trip_distance"), F.lit(5.0).alias("fare_amount"), F.lit(6.0).alias("total_amount"), F.col("id").cast("int").alias("rid"))
    back = base.where("rid % 200 < 2").withColumns({"fare_amount": F.lit(-5.0), "total_amount": F.lit(-6.0)})
    again = base.where("rid % 400 = 1")  # charge, reversal and charge again
    df = base.unionByName(back).unionByName(again).repartition(5).checkpoint()
    some = dedup.pair_candidates(df, COLS)
    want, got = dedup.reversal_groups(df, COLS), dedup.reversal_groups(some, COLS)
    assert sorted(map(str, want.collect())) == sorted(map(str, got.collect())) and want.count() > 100
    assert _shuffled_rows(got) < _shuffled_rows(want) / 2
    assert some.count() < df.count() / 20
    assert dedup.pair_candidates(df, COLS, limit=1024) is df
    for plan in ("fused", "pruned"):
        assert kept(_remove_pairs_and_duplicates(df, COLS, plan)) == kept(_remove_pairs_and_duplicates(df, COLS, "literal"))
