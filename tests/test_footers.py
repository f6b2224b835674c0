"""The footer catalogue: every footer once, groups by types."""
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import StructType

from farelane.sources import files, footers

TYPES = {"a": "id int, n int", "b": "id bigint, n double", "c": "ID int, extra string"}


def land(spark, root, month, kind):
    spark.createDataFrame([(1, None)], TYPES[kind]).write.parquet(f"{root}/raw_file=yellow_tripdata_{month}.parquet")


def test_alternating_types_over_many_files_take_one_job(spark, tmp_path):
    months = [f"{2000 + i // 12}-{1 + i % 12:02d}" for i in range(80)]
    for i, month in enumerate(months):
        schema = pa.schema([("id", pa.int32() if i % 2 else pa.int64()), ("n", pa.int32() if i % 2 else pa.float64())])
        (tmp_path / f"yellow_tripdata_{month}.parquet").parent.mkdir(exist_ok=True)
        pq.write_table(pa.table({"id": [i], "n": [i]}, schema=schema), tmp_path / f"yellow_tripdata_{month}.parquet")
    tracker, before = spark.sparkContext.statusTracker(), set()
    spark.sparkContext.setJobGroup("footers", "catalogue")
    groups = footers.scan_groups(spark, files.month_glob(str(tmp_path), "yellow"))
    jobs = set(tracker.getJobIdsForGroup("footers")) - before
    spark.sparkContext.setJobGroup("other", "")
    assert len(jobs) <= 4  # the catalogue and the reduction of its rows, not one for each change
    assert [len(p) for _, p in groups] == [40, 40]
    got = files.read_reconciled(spark, files.month_glob(str(tmp_path), "yellow"))
    assert dict(got.dtypes)["n"] == "double" and dict(got.dtypes)["id"] == "bigint"
    assert sorted((r.id, r.n, r.file_year, r.file_month) for r in got.collect()) == [
        (i, float(i), m[:4], m[5:]) for i, m in enumerate(months)]


def test_columns_that_come_and_go_share_a_scan(spark, tmp_path):
    for month, kind in (("2024-01", "a"), ("2024-02", "c"), ("2024-03", "b")):
        land(spark, tmp_path, month, kind)
    groups = footers.scan_groups(spark, files.month_glob(str(tmp_path), "yellow"))
    assert sorted(len(p) for _, p in groups) == [1, 2]
    schema = next(s for s, p in groups if len(p) == 2)
    assert [f.name.lower() for f in schema.fields] == ["id", "n", "extra"]


def test_files_of_one_dataset_that_conflict_are_listed(spark, tmp_path):
    land(spark, tmp_path, "2024-01", "a")
    spark.createDataFrame([(2, 2.5)], TYPES["b"]).write.mode("append").parquet(f"{tmp_path}/raw_file=yellow_tripdata_2024-01.parquet")
    land(spark, tmp_path, "2024-02", "a")
    groups = footers.scan_groups(spark, files.month_glob(str(tmp_path), "yellow"))
    paths = [p for _, some in groups for p in some]
    assert sum(p.endswith("2024-02.parquet") for p in paths) == 1 and sum("part-" in p for p in paths) == len(paths) - 1


def test_the_catalogue_counts_rows_without_reading_them(spark, tmp_path):
    pq.write_table(pa.table({"x": list(range(7))}), tmp_path / "yellow_tripdata_2024-05.parquet")
    row = footers.footer_catalogue(spark, str(tmp_path)).first()
    assert row.n_rows == 7 and row.dataset == row.path and StructType.fromJson(__import__("json").loads(row.schema)).names == ["x"]


def test_nothing_to_read_is_said(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        footers.scan_groups(spark, f"{tmp_path}/empty")
