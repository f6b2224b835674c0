"""Reject channels, lookup checks, clustered files, run-time pruning, sketches."""
import random
import re

import pytest
from pyspark.sql import functions as F

from farelane import catalog, jobs
from farelane.operators import shape
from farelane.plans import profile
from farelane.session import scratch_path
from farelane.sinks import parquet as sink
from farelane.sources import dims, files

SF = "/root/testdata/sf0.001"


def test_a_malformed_value_rejects_its_row_alone(spark):
    layout = (("a", "a", "int"), ("b", "b", "timestamp"), ("c", "c", "double"), ("d", "d", "string"))
    df = spark.createDataFrame([("1", "2024-01-01 00:00:00", "2.5", "x"), ("one", None, "2,5", None), (None, "never", None, ""), (None,) * 4],
                               "a string, b string, c string, d string")
    got = shape.cast_or_reject(df, layout)
    rows = got.collect()
    assert [(r.a, r.c, r.d, r.failed_columns, r.failed_values) for r in rows] == [
        (1, 2.5, "x", [], []), (None, None, None, ["a", "c"], ["one", "2,5"]), (None, None, "", ["b"], ["never"]), (None, None, None, [], [])]
    assert dict(got.dtypes)["b"] == "timestamp_ntz" and got.where(shape.is_reject()).count() == 2
    with pytest.raises(Exception):
        shape.cast_layout(df, layout).collect()
    assert shape.cast_or_reject(df.where("false"), layout).count() == 0


def test_lookup_lines_are_told_apart(spark):
    path = scratch_path(spark, "lines")
    lines = ['code, name, note', '1, "a ""b"", c", z,', '2, "open, z', '3, "ok", z, extra', '4, "ok"', 'x5, "ok", z', ', "ok", z', '7,, ', '  ', '7, "seven", NA\r']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {r.line: (r.code, r.name, r.note, r.reason) for r in dims.read_csv_checked(spark, path, "code int, name string, note string", "code").collect()}
    assert got == {
        lines[1]: (1, 'a "b", c', "z", None), lines[2]: (2, got[lines[2]][1], got[lines[2]][2], "unclosed quote"),
        lines[3]: (3, "ok", "z", "too many fields"), lines[4]: (4, "ok", None, "too few fields"),
        lines[5]: (None, "ok", "z", "bad code"), lines[6]: (None, "ok", "z", "no key"), "7,,": (7, None, None, None), '7, "seven", NA': (7, "seven", "NA", None)}
    sound = dims.read_csv_checked(spark, path, "code int, name string, note string", "code").where("reason IS NULL")
    assert [tuple(r) for r in dims.doubled_keys(sound, "code").collect()] == [(7, 2)]


def test_a_strict_job_stops_at_broken_lookups(spark, tmp_path):
    folder = catalog.lookup_folder(spark, SF)
    assert dims.check_lookup_folder(spark, folder) == []
    broken = f"{tmp_path}/lookups"
    for name, df in dims.read_lookup_folder(spark, folder).items():
        dims.write_lookup_csv(df.unionByName(df.limit(1)) if name == "ratecode" else df, f"{broken}/{name}.csv")
    assert dims.check_lookup_folder(spark, broken) == [("ratecode", "doubled key", 1)]
    with pytest.raises(ValueError, match="ratecode: 1 x doubled key"):
        jobs.run_job(spark, "yellow", "full_load", 0, str(tmp_path), broken, f"{tmp_path}/out")


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().length())]
    return sum(found)


def test_a_lookup_on_clustered_files_reads_few_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [("2024", f"{1 + i % 2:02d}", rng.randrange(2000), rng.randrange(10**6), "x" * 40 + str(i)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "file_year string, file_month string, place int, other int, text string")
    wanted = rows[7]
    seen = {}
    for name in ("plain", "clustered"):
        path = f"{tmp_path}/{name}"
        if name == "plain":
            sink.write_partitioned(df, path)
        else:
            sink.write_clustered(df, path, ["place"], ["other"], row_group_bytes=64 * 1024)
        held = spark.read.parquet(path).where((F.col("place") == wanted[2]) & (F.col("other") == wanted[3]))
        seen[name] = rows_scanned(held)
        assert wanted[4] in {r.text for r in held.collect()}
    assert seen["plain"] > 20_000 and seen["clustered"] < seen["plain"] / 5
    bloomed = spark.read.parquet(f"{tmp_path}/clustered").where("other = -5")
    assert rows_scanned(bloomed) == 0


def test_last_months_are_pruned_at_run_time(spark, capsys):
    path = catalog._curated_table(spark, SF)
    df = files.read_last_months(spark, path, 2, files.curated_schema())
    capsys.readouterr()
    df.explain(mode="formatted")
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", capsys.readouterr().out)
    every = sorted({(r.file_year, r.file_month) for r in files.read_partitioned(spark, path, files.curated_schema()).select("file_year", "file_month").distinct().collect()})
    assert sorted({(r.file_year, r.file_month) for r in df.select("file_year", "file_month").distinct().collect()}) == every[-2:]
    with pytest.raises(ValueError):
        files.read_last_months(spark, path, 0)


def test_sketches_merge_within_their_error(spark):
    rng = random.Random(4)
    rows = [(f"{1 + i % 3:02d}", rng.choice(["a", None]), 5.0 if rng.random() < 0.4 else rng.gauss(10, 4)) for i in range(30_000)]
    rows += [("01", "only nulls", None)]
    df = spark.createDataFrame(rows, "file_month string, g string, v double")
    sketches = profile.month_sketches(df, ["g"], "v", ["file_month"])
    assert sketches.count() == 6
    probs = {"low": 0.05, "mid": 0.5, "top": 0.99}
    for r in profile.sketch_quantiles(sketches, ["g"], probs).collect():
        values = sorted(v for _, g, v in rows if g == r.g)
        assert r.n == len(values)
        for name, p in probs.items():
            below, upto = (sum(v < r[name] for v in values) / r.n, sum(v <= r[name] for v in values) / r.n)
            assert below - profile.RANK_ERROR <= p <= upto + profile.RANK_ERROR
