"""Rows that share their pair keys with none are not shuffled; wide copies are Parquet."""
from pyspark.sql import functions as F

from farelane import session
from farelane.operators import dedup
from farelane.plans import curate, quality
from farelane.session import METHOD_LIMIT, ensure_plan_settings
from farelane.spec import TripColumns


def rows(df):
    return sorted(map(str, df.collect()))


def test_groups_stay_whole_and_single_rows_stay_out(spark):
    df = spark.sql("""SELECT CASE WHEN id % 50 = 0 THEN NULL ELSE id END AS a, CASE WHEN id % 3 = 0 THEN -0.0D ELSE 0.0D END AS z, id FROM range(3000)
                      UNION ALL SELECT id, 0.0D, id + 10000 FROM range(1, 3000, 40)""")
    alone, together = dedup.split_shared(df, ["a", "z"])
    assert rows(alone.unionAll(together)) == rows(df)
    assert alone.where("a IS NULL").count() == 0 and alone.groupBy("a").count().where("count > 1").count() == 0
    shared = df.groupBy("a").count().where("count > 1 AND a IS NOT NULL").count()
    assert together.count() < 60 + 2 * shared + 100 and alone.count() > 2500
    none, everything = dedup.split_shared(df, ["a", "z"], limit=1024)
    assert none is None and everything is df


def test_more_hashes_send_their_rows_together(spark):
    df = spark.range(1000)
    alone, together = dedup.split_shared(df, ["id"], df.where("id = 7").select(F.xxhash64("id").alias("_h")))
    assert together.where("id = 7").count() == 1 and alone.where("id = 7").count() == 0


def test_duplicates_are_counted_by_their_rows_alone(spark):
    df = spark.sql("SELECT id % 900 AS a, CASE WHEN id = 5 THEN NULL ELSE 1 END AS b FROM range(1000)")
    assert quality.duplicate_report(df, ("a", "b")).first().bad_rows == df.groupBy("a", "b").count().where("count > 1").count() == 99


def test_staged_copies_are_smaller_than_rows_in_memory(spark):
    df = spark.range(50_000).select(*[(F.col("id") % 7).alias(f"c{i}") for i in range(40)])
    held = session.staged(df, "wide")
    path = held.inputFiles()[0].rsplit("/", 1)[0]
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    assert held.schema == df.schema and held.count() == 50_000 and size < 50_000 * 40 * 8 / 10
    session.remove_path(spark, path)


def test_the_method_limit_is_set_where_the_session_has_none(spark):
    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "9000")
        ensure_plan_settings(spark)
        assert spark.conf.get(METHOD_LIMIT) == "9000"
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_bitmaps_hold_every_place(spark):
    places = spark.range(0, 40_000, 3).select(F.col("id").alias("_h"))
    bitmaps = dedup.key_bitmaps(places)

    class Plain(dedup.KeyBitmaps):
        def _place(self, keys):
            return F.col(keys[0])
    probe = Plain(bitmaps.rows, bitmaps.bits)
    met = spark.range(bitmaps.bits).join(F.broadcast(bitmaps.rows), probe.bucket(["id"]), "left")
    hits = met.where(F.coalesce(probe.hit(["id"]), F.lit(False))).select("id")
    assert rows(hits) == rows(places.withColumnRenamed("_h", "id"))


TRIPS = """SELECT CAST({v} AS INT) AS VendorID, TIMESTAMP_NTZ '2023-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id % 40 AS INT)) AS pickup_datetime,
  TIMESTAMP_NTZ '2023-01-01 05:00:00' AS dropoff_datetime, 7 AS PULocationID, 8 AS DOLocationID, 1.5D AS trip_distance,
  CAST({f} AS DOUBLE) AS fare_amount, CAST({t} AS DOUBLE) AS total_amount, id AS rid FROM range({n})"""


def test_rows_that_share_pair_keys_alone_are_not_shuffled(spark):
    """Fifty rows a pair key, all of other fares; a pair, and duplicates, among other keys."""
    cols = TripColumns(tiebreak=("rid",))
    many = spark.sql(TRIPS.format(v=1, f="id + 1", t="id + 2", n=2000))
    pair = spark.sql(TRIPS.format(v=2, f="CASE WHEN id < 40 THEN 5 ELSE -5 END", t="CASE WHEN id < 40 THEN 6 ELSE -6 END", n=80))
    twice = spark.sql(TRIPS.format(v=3, f="id % 40 + 1", t="id", n=80))
    nulls = spark.sql(TRIPS.format(v="NULL", f="id % 40 + 1", t="id + 1", n=80))
    zeros = spark.sql(TRIPS.format(v=4, f="id + 1", t="CASE WHEN id >= 40 THEN NULL ELSE 0 END", n=80))
    df = many.unionByName(pair).unionByName(twice).unionByName(nulls).unionByName(zeros)
    _, alone, together = curate.apart(df, cols)
    assert rows(alone.unionAll(together)) == rows(df)
    assert together.count() < 80 * 4 + 400 and alone.where("VendorID = 1").count() > 1600
    kept = {plan: rows(curate._remove_pairs_and_duplicates(df, cols, plan).select("rid", "VendorID")) for plan in ("fused", "window", "pruned")}
    assert kept["fused"] == kept["window"] == kept["pruned"]
    assert len(kept["fused"]) == 2000 + 40 + 40  # many, the better of twice, of nulls
