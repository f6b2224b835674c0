"""File provenance, schema vintages, run modes, calendar, dynamic overwrite, CSV lookups."""
import os

import pytest
from pyspark.sql import functions as F

from farelane.session import scratch_path
from farelane.sinks import parquet as sink
from farelane.sources import calendar, dims, files, runmodes


def _land(spark, root, rows, schema, vehicle="yellow"):
    df = spark.createDataFrame(rows, schema)
    return files.write_month_files(df, root, vehicle)


def test_file_month_from_file_name_not_from_folders(spark):
    root = scratch_path(spark, "t") + "/snap-1999-12"
    _land(spark, root, [(1, "2024", "03"), (2, "2024", "04")], "id int, file_year string, file_month string")
    df = files.with_file_month(files.read_months(spark, files.month_glob(root, "yellow")))
    assert sorted((r.id, r.file_year, r.file_month) for r in df.collect()) == [(1, "2024", "03"), (2, "2024", "04")]


def test_plain_file_names_work_too(spark, tmp_path):
    spark.createDataFrame([(7,)], "id int").toPandas().to_parquet(tmp_path / "green_tripdata_2023-11.parquet")
    df = files.with_file_month(spark.read.parquet(str(tmp_path / "*green_tripdata_*.parquet")))
    assert [(r.file_year, r.file_month) for r in df.collect()] == [("2023", "11")]


def test_case_variants_merge_and_types_widen(spark):
    root = scratch_path(spark, "t")
    _land(spark, root, [(1, 2.5, "2024", "01")], "VendorID int, airport_fee double, file_year string, file_month string")
    _land(spark, root, [(2, 3.5, "2024", "02")], "VendorID bigint, Airport_fee double, file_year string, file_month string")
    _land(spark, root, [(3.0, 1.0, "2024", "03")], "VendorID double, Airport_fee double, file_year string, file_month string")
    df = files.read_reconciled(spark, files.month_glob(root, "yellow"))
    assert dict(df.dtypes)["VendorID"] == "double"
    got = sorted((r.VendorID, r.airport_fee, r.file_month) for r in df.collect())
    assert got == [(1.0, 2.5, "01"), (2.0, 3.5, "02"), (3.0, 1.0, "03")]


def test_run_modes(spark):
    root = scratch_path(spark, "t")
    rows = [(i, "2024", f"{m:02d}") for i, m in enumerate(range(1, 7))]
    _land(spark, root, rows, "id int, file_year string, file_month string")
    last = runmodes.select_months(spark, root, "yellow", "past_months", 2)
    assert sorted(r.file_month for r in last.collect()) == ["05", "06"]
    one = runmodes.select_months(spark, root, "yellow", "specific_month", 202403)
    assert [r.file_month for r in one.collect()] == ["03"]
    assert runmodes.select_months(spark, root, "yellow", "full_load").count() == 6
    for mode, arg in [("past_months", 0), ("past_months", 300), ("specific_month", 202413),
                      ("specific_month", 200812), ("bogus", 1)]:
        with pytest.raises(runmodes.RunModeError):
            runmodes.select_months(spark, root, "yellow", mode, arg)


def test_publication_horizon_lag(spark):
    bounds = spark.createDataFrame([(2022, "2025-02-15"), (2022, "2025-03-01")], "first_year int, as_of string")
    jan = calendar.publication_years(bounds.limit(1).withColumn("as_of", F.to_date("as_of")))
    assert [r.year for r in jan.collect()] == [2022, 2023, 2024]
    mar = calendar.publication_years(bounds.filter("as_of = '2025-03-01'").withColumn("as_of", F.to_date("as_of")))
    assert [r.year for r in mar.collect()] == [2022, 2023, 2024, 2025]


def test_dynamic_overwrite_replaces_only_written_months(spark):
    target = scratch_path(spark, "t")
    schema = "id int, file_year string, file_month string"
    sink.write_partitioned(spark.createDataFrame([(1, "2024", "01"), (2, "2024", "02")], schema), target)
    sink.write_partitioned(spark.createDataFrame([(3, "2024", "02")], schema), target)
    back = files.read_partitioned(spark, target, schema)
    assert sorted((r.id, r.file_month) for r in back.collect()) == [(1, "01"), (3, "02")]


def test_lookup_csv_quirks(spark):
    src = spark.createDataFrame([(1, " JFK", "NA"), (99, "N/A", "x")], "code int, name string, note string")
    path = dims.write_lookup_csv(src.repartition(2), scratch_path(spark, "csv"))
    local = path.replace("file:", "")
    for f in sorted(os.listdir(local)):
        if f.startswith("part-"):
            text = open(os.path.join(local, f), newline="").read()
            lines = text.split("\r\n")
            assert lines[0] == "code, name, note"          # a header in every file
            assert all(x.endswith(",") for x in lines[1:] if x)  # trailing comma, CRLF
    back = dims.read_csv_dim(spark, path, "code int, name string, note string")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "JFK", "NA"), (99, "N/A", "x")]


def curated_frame(spark, rows):
    cols = [c.split()[0] for c in files.curated_schema().split(", ")]
    out = []
    for fy, fm, vendor in rows:
        r = dict({c: None for c in cols}, file_year=fy, file_month=fm, vendor_id=vendor)
        out.append(tuple(r[c] for c in cols))
    return spark.createDataFrame(out, files.curated_schema())


def test_publish_empties_a_processed_month_without_rows(spark):
    target = scratch_path(spark, "t")
    sink.gated_publish(curated_frame(spark, [("2024", "01", 1), ("2024", "02", 2)]), target, strict=False)
    # February is processed again and loses all its rows; January is not processed
    sink.gated_publish(curated_frame(spark, []), target, strict=False, months=[("2024", "02")])
    back = files.read_partitioned(spark, target, files.curated_schema())
    assert [(r.file_month, r.vendor_id) for r in back.collect()] == [("01", 1)]
    # a strict gate on nothing passes, and a month that never existed stays empty
    assert sink.gated_publish(curated_frame(spark, []), target, strict=True, months=[("2024", "03")]) == []
    assert back.count() == 1


def test_no_folder_but_the_checkpoint_without_a_shared_one(spark, monkeypatch):
    from farelane import session

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_other_files_and_blanks_in_paths(spark):
    root = scratch_path(spark, "a b")
    _land(spark, root, [(1, "2024", "01"), (2, "2024", "02")], "id int, file_year string, file_month string")
    one = spark.createDataFrame([(9,)], "id int")
    one.write.parquet(f"{root}/bak_yellow_tripdata_2024-01.parquet")
    one.write.parquet(f"{root}/green_tripdata_2024-05.parquet")
    assert files.months_of(spark, root, "yellow") == [("2024", "01"), ("2024", "02")]
    for mode, n, want in (("full_load", 0, [1, 2]), ("past_months", 1, [2])):
        assert sorted(r.id for r in runmodes.select_months(spark, root, "yellow", mode, n).collect()) == want


def test_every_footer_of_a_month_counts(spark):
    root = scratch_path(spark, "t")
    _land(spark, root, [(1, "2024", "01")], "id int, file_year string, file_month string")
    month = f"{root}/raw_file=yellow_tripdata_2024-01.parquet"
    spark.createDataFrame([(2, "x")], "id int, extra string").write.mode("append").parquet(month)
    got = files.read_reconciled(spark, files.month_glob(root, "yellow"))
    assert sorted((r.id, r.extra) for r in got.collect()) == [(1, None), (2, "x")]
    # files of one month whose types conflict are told apart too
    spark.createDataFrame([(3.5, "y")], "id double, extra string").write.mode("append").parquet(month)
    got = files.read_reconciled(spark, files.month_glob(root, "yellow"))
    assert sorted((r.id, r.extra or "", r.file_month) for r in got.collect()) == [(1.0, "", "01"), (2.0, "x", "01"), (3.5, "y", "01")]


def test_csv_keeps_nulls_and_quotes_in_place(spark):
    src = spark.createDataFrame([(1, None, "z"), (2, 'a "b", c', None)], "code int, name string, note string")
    path = dims.write_lookup_csv(src, scratch_path(spark, "csv"))
    got = {r.code: (r.name, r.note) for r in dims.read_csv_dim(spark, path, "code int, name string, note string").collect()}
    assert got == {1: (None, "z"), 2: ('a "b", c', None)}


def test_gated_publish_replaces_months(spark):
    from farelane.plans import quality
    from farelane.sources.files import curated_schema
    target = scratch_path(spark, "t")
    frame = lambda rows: curated_frame(spark, rows)
    sink.gated_publish(frame([("2024", "01", 1), ("2024", "02", 2)]), target, strict=False)
    sink.gated_publish(frame([("2024", "02", 3), ("2024", "02", 4)]), target, strict=False)
    back = files.read_partitioned(spark, target, curated_schema())
    assert sorted((r.file_month, r.vendor_id) for r in back.collect()) == [("01", 1), ("02", 3), ("02", 4)]
    with pytest.raises(quality.QualityError):
        sink.gated_publish(frame([("2024", "01", 9)]), target, strict=True)
    again = files.read_partitioned(spark, target, curated_schema())
    assert sorted((r.file_month, r.vendor_id) for r in again.collect()) == [("01", 1), ("02", 3), ("02", 4)]


def test_expected_and_missing_months_for_a_run_date(spark):
    b = calendar.bounds(spark, "2025-02-10")  # Jan/Feb: the year list stops at 2024
    exp = calendar.expected_months(b, vehicles=("yellow",))
    assert exp.count() == 3 * 12  # 2022, 2023, 2024
    seen = spark.createDataFrame([("yellow", 2024, m) for m in range(1, 12)], "vehicle string, year int, month int")
    missing = calendar.missing_months(exp.filter("year = 2024"), seen)
    assert [(r.year, r.month) for r in missing.collect()] == [(2024, 12)]


def test_file_month_reads_the_path_uncut_and_its_end_alone(spark, capsys):
    root = scratch_path(spark, "t") + "/yellow_tripdata_1999-12.parquet/more_1998-11.parquet"
    _land(spark, root, [(1, "2024", "03")], "id int, file_year string, file_month string")
    raw = files.read_months(spark, files.month_glob(root, "yellow"))
    df = files.with_file_month(raw)
    assert [tuple(r) for r in df.select("file_year", "file_month").collect()] == [("2024", "03")]
    capsys.readouterr()
    df.explain()
    assert "substring_index" not in capsys.readouterr().out
    other = files.with_file_month(raw, r"_(\d{4}-\d{2})\.parquet")  # not anchored: cut first
    assert [tuple(r) for r in other.select("file_year", "file_month").collect()] == [("2024", "03")]
