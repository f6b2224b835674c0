"""Physical-plan shape: pushdown, pruning, map-side reduction, broadcasts."""
import re

from pyspark.sql import functions as F

from farelane import catalog
from farelane.operators import enrich, harmonize
from farelane.plans.curate import curate
from farelane.sources import dims, files, trips

SF = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_curation_reduces_before_each_shuffle(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = harmonize.harmonize_a(trips.read_landed(spark, SF, "a"))
        out = curate(raw, catalog.adapter_dims(spark, SF), trips.ADAPTER_COLUMNS)
        plan = plan_of(out, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("WindowGroupLimit") >= 2           # partial top-1 below the exchange + final
    assert "partial_count" in plan and "partial_sum" in plan  # map-side pair statistics
    assert "LeftAnti" in plan
    assert "input_file_name" not in plan


def test_file_month_keeps_pushdown_and_pruning(spark, capsys):
    df = trips.read_landed(spark, SF, "a").filter(F.col("trip_distance") > 5).select("trip_distance", "file_year")
    plan = plan_of(df, capsys)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(trip_distance,5\.0\)", plan)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert read_schema == "trip_distance:double"


def test_partition_filters_prune_folders(spark, capsys):
    path = catalog._curated_table(spark, SF)
    df = files.read_partitioned(spark, path, files.curated_schema(), where="file_year = '1998' AND file_month = '01'")
    plan = plan_of(df, capsys)
    assert re.search(r"PartitionFilters: \[.*file_year.*1998", plan)


def test_point_lookup_is_pushed_to_the_scan(spark, capsys):
    plan = plan_of(catalog.point_lookup(spark, SF), capsys)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for col in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"):
        assert f"EqualTo({col}," in pushed


def test_code_tables_are_broadcast_without_a_count_job(spark, capsys):
    codes = dims.code_tables(spark)
    facts = spark.range(10).select(F.col("id").alias("RatecodeID"))
    plan = plan_of(enrich.lookup_join(facts, codes["ratecode"], "RatecodeID"), capsys)
    assert "BroadcastHashJoin" in plan


def test_curation_shuffles_facts_three_times_and_never_on_a_code(spark, capsys):
    plan = plan_of(catalog.curate_trips(spark, SF), capsys)
    tree = plan[plan.index("== Physical Plan =="):plan.index("(1) ")]
    assert tree.count("SortMergeJoin") <= 1  # the pair members; no code or zone
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert len(keys) <= 3 and not any(k.split("#")[0] in ("RatecodeID", "payment_type") for k in keys)
