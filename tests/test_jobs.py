"""The batch job end to end: landed raw files + lookup CSV folder -> curated months."""
from pyspark.sql import functions as F

from farelane import catalog, jobs, spec
from farelane.operators import harmonize
from farelane.plans.curate import curate
from farelane.session import scratch_path
from farelane.sources import files, trips
from farelane.streaming.incremental import run_incremental

SF = "/root/testdata/sf0.001"


def _lookup_folder(spark):
    return catalog.lookup_folder(spark, SF)


def test_job_both_flavours_matches_the_curation_query(spark):
    raw_root = scratch_path(spark, "raw-root")
    for flavour, vehicle in trips.FLAVOUR_VEHICLE.items():
        src = trips.flavour_a_raw(spark, SF) if flavour == "a" else trips.flavour_b_raw(spark, SF)
        files.write_month_files(src, f"{raw_root}/{vehicle}", vehicle)
    out = scratch_path(spark, "curated-root")
    report = jobs.run_job(spark, "both", "full_load", 0, raw_root, _lookup_folder(spark), out,
                          cols=trips.ADAPTER_COLUMNS)
    assert report == {"green": [], "yellow": []}
    tables = catalog.adapter_dims(spark, SF)
    curated = {}
    for vehicle, raw in (("yellow", catalog.raw_a(spark, SF)),
                         ("green", harmonize.harmonize_b(trips.read_landed(spark, SF, "b")))):
        expected = curate(raw, tables, trips.ADAPTER_COLUMNS)
        got = curated[vehicle] = files.read_partitioned(spark, f"{out}/{vehicle}", files.curated_schema())
        assert got.count() == expected.count() > 5000
        assert got.exceptAll(expected).count() == 0
    assert curated["yellow"].exceptAll(curated["green"]).count() > 1000  # airport fee here, e-hail fee there


def test_job_on_vintages_whose_types_drift_and_session_zone_timestamps(spark):
    raw_root, out = scratch_path(spark, "raw-root"), scratch_path(spark, "curated-root")
    src = trips.flavour_a_raw(spark, SF)
    old, new = "file_year < '1997'", "file_year >= '1997'"
    files.write_month_files(src.where(old), f"{raw_root}/yellow", "yellow")
    files.write_month_files(src.where(new).withColumns({"VendorID": F.col("VendorID").cast("bigint"),
                                                        "passenger_count": F.col("passenger_count").cast("double")}),
                            f"{raw_root}/yellow", "yellow")
    report = jobs.run_job(spark, "yellow", "full_load", 0, raw_root, _lookup_folder(spark), out,
                          cols=trips.ADAPTER_COLUMNS, timestamp_type="ltz")
    assert report == {"yellow": []}
    got = files.read_partitioned(spark, f"{out}/yellow", files.curated_schema(timestamp_type="ltz"))
    assert got.count() == catalog.curate_trips(spark, SF).count()


def test_stream_gives_the_same_rows_for_any_batch_size(spark):
    """A charge in the May file and its reversal in the June file."""
    raw = trips.flavour_a_raw(spark, SF).where("copy_no = 0 AND l_partkey % 97 <> 0")
    pick = raw.orderBy(*trips.IDENTITY).limit(1)
    charge = pick.withColumns({"file_year": F.lit("1998"), "file_month": F.lit("05")})
    charges = [c for c in spec.TOTAL_COMPONENTS if c in raw.columns]
    reversal = charge.withColumns({"file_month": F.lit("06"), "copy_no": F.lit(1), **{c: -F.col(c) for c in charges}})
    other = raw.where("file_year = '1998' AND file_month = '04'").limit(5)
    folder = scratch_path(spark, "raw-stream")
    files.write_month_files(charge.unionByName(reversal).unionByName(other), folder, "yellow")
    tables = catalog.adapter_dims(spark, SF)
    results = []
    for size in (1, 3, 0):
        target = scratch_path(spark, "curated-stream")
        run_incremental(spark, folder, "yellow", target, scratch_path(spark, "stream-ckpt"),
                        lambda df, cols: curate(harmonize.harmonize_a(df), tables, cols), trips.ADAPTER_COLUMNS, size)
        results.append(sorted(map(str, files.read_partitioned(spark, target, files.curated_schema()).collect())))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 6  # the charge stays: its reversal, in another file, is dropped as negative


def test_job_past_months_replaces_only_those_months(spark):
    raw_root = scratch_path(spark, "raw-root")
    files.write_month_files(trips.flavour_a_raw(spark, SF), f"{raw_root}/yellow", "yellow")
    out = scratch_path(spark, "curated-root")
    lookups = _lookup_folder(spark)
    jobs.run_job(spark, "yellow", "full_load", 0, raw_root, lookups, out, cols=trips.ADAPTER_COLUMNS)
    before = files.read_partitioned(spark, f"{out}/yellow", files.curated_schema())
    n_before = before.count()
    months_before = before.select("file_year", "file_month").distinct().count()
    jobs.run_job(spark, "yellow", "past_months", 2, raw_root, lookups, out, cols=trips.ADAPTER_COLUMNS)
    after = files.read_partitioned(spark, f"{out}/yellow", files.curated_schema())
    # the last two months were rebuilt from the same raw files: nothing changes
    assert after.count() == n_before
    assert after.select("file_year", "file_month").distinct().count() == months_before
    assert after.agg(F.max(F.concat("file_year", "file_month"))).first()[0] == "200108"
