"""What a run stages goes as soon as nothing reads it."""
import datetime as dt
import glob
import os

from farelane import catalog, session
from farelane.sources import trips


def _scratch(spark):
    root = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.basename(x) for x in glob.glob(f"{root}/farelane-scratch/*")} | {
        os.path.basename(x) for x in glob.glob(f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file:')}/farelane-scratch/*")}


def _tables(spark, folder):
    lines = [(k, 1 + k % 9, 2 + k % 5, 1, 5.0 + k % 7, 1000.0 + k, 0.05, 0.02, "N") for k in range(1, 121)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                                 " l_discount double, l_tax double, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    orders = [(k, 1 + k % 3, dt.datetime(1997, 1 + k % 2, 3)) for k in range(1, 121)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(k, f"nation {k}", k % 5) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(k, f"region {k}") for k in range(5)], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    return folder


def test_both_flavours_leave_the_published_tables_alone(spark, tmp_path):
    before, folder = _scratch(spark), _tables(spark, str(tmp_path))
    both = catalog.QUERIES["curate_both"](spark, folder)
    left = {x.rsplit("-", 1)[0] for x in _scratch(spark) - before}
    assert left == {f"curated-{v}" for v in trips.FLAVOUR_VEHICLE.values()}
    first = sorted(map(str, both.collect()))
    assert first
    # raw files that the session had already stay for others
    trips.land_raw(spark, folder, "a")
    assert sorted(map(str, catalog.QUERIES["curate_both"](spark, folder).collect())) == first
    assert trips.is_landed(spark, folder, "a") and not trips.is_landed(spark, folder, "b")
    assert trips.read_landed(spark, folder, "a").count() > 120


def test_staged_copies_stay_without_a_run(spark):
    kept = session.staged(spark.range(3), "kept")
    with session.staging(spark):
        with session.staging(spark):
            inner = session.staged(spark.range(4), "inner")
            outer = inner.inputFiles()
            session.drop_staged(spark)
            assert not any(os.path.exists(x.removeprefix("file://")) for x in outer)
    session.drop_staged(spark)
    assert kept.count() == 3
