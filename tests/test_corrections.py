"""Months that are landed again, go, or hold the other half of a pair."""
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farelane import catalog
from farelane.operators import clean, dedup, harmonize, shape
from farelane.plans.curate import complete, curate, prepare
from farelane.sources import files, trips
from farelane.streaming import corrections
from frames import ts

RAW = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double, "
       "RatecodeID double, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, "
       "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, congestion_surcharge double, total_amount double, "
       "Airport_fee double, l_orderkey long, l_partkey long, l_suppkey long, copy_no int, file_year string, file_month string")
SF = "/root/testdata/sf0.001"


def trip(n, fare, month, copy=0, minute=None, tip=0.0, year="1997"):
    start = ts(f"1997-05-01 10:{(minute if minute is not None else n) % 60:02d}:00")
    return (1, start, ts("1997-05-01 11:30:00"), 1.0, 3.0, 1.0, "N", 5, 6, 1, fare, 0.0, 0.0, tip, 0.0, 0.0, 0.0, fare, 0.0, n, n, n, copy, year, month)


def land(spark, folder, rows):
    files.write_month_files(spark.createDataFrame(rows, RAW), folder, "yellow")


def run(spark, tmp, scope, step=0, target=None):
    return corrections.run_corrections(spark, f"{tmp}/raw", "yellow", target or f"{tmp}/out", f"{tmp}/home", harmonize.harmonize_a,
                                       catalog.adapter_dims(spark, SF), trips.ADAPTER_COLUMNS, pair_scope=scope, months_per_step=step)


def table(spark, path):
    out = files.read_partitioned(spark, path, files.curated_schema())
    return sorted((r.file_year + r.file_month, r.pickup_datetime, r.fare_amount, r.total_amount) for r in out.collect())


def loaded(spark, tmp):
    raw = files.read_reconciled(spark, files.month_glob(f"{tmp}/raw", "yellow"))
    out = curate(harmonize.harmonize_a(raw), catalog.adapter_dims(spark, SF), trips.ADAPTER_COLUMNS)
    return sorted((r.file_year + r.file_month, r.pickup_datetime, r.fare_amount, r.total_amount) for r in out.collect())


def test_a_month_landed_again_under_its_name_is_rebuilt(spark, tmp_path):
    rows = [trip(n, 10.0 + n, f"{1 + n % 3:02d}") for n in range(9)]
    land(spark, f"{tmp_path}/raw", rows)
    assert [s for s, _ in run(spark, tmp_path, "month")] == [[("1997", "01"), ("1997", "02"), ("1997", "03")]]
    before = table(spark, f"{tmp_path}/out")
    assert run(spark, tmp_path, "month") == []  # nothing changed
    # the very same file name and, but for the values, the same size
    month = tmp_path / "raw" / "raw_file=yellow_tripdata_1997-02.parquet"
    file = next(f for f in month.iterdir() if f.suffix == ".parquet")
    data = pq.ParquetFile(file).read()
    at = data.schema.get_field_index("fare_amount")
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    pq.write_table(data.set_column(at, data.schema.field(at), [[99.0] * data.num_rows]), file)
    assert run(spark, tmp_path, "month") == [([("1997", "02")], [])]
    after = table(spark, f"{tmp_path}/out")
    assert [r for r in after if r[0] != "199702"] == [r for r in before if r[0] != "199702"]
    assert {r[2] for r in after if r[0] == "199702"} == {99.0}


@pytest.mark.parametrize("scope", ["month", "load"])
def test_a_month_whose_files_go_is_emptied(spark, tmp_path, scope):
    import shutil
    land(spark, f"{tmp_path}/raw", [trip(n, 10.0 + n, f"{1 + n % 2:02d}") for n in range(4)])
    run(spark, tmp_path, scope)
    shutil.move(f"{tmp_path}/raw/raw_file=yellow_tripdata_1997-01.parquet", f"{tmp_path}/gone")
    assert run(spark, tmp_path, scope) == [([("1997", "01")], [])]
    assert {r[0] for r in table(spark, f"{tmp_path}/out")} == {"199702"}
    assert run(spark, tmp_path, scope) == []


def test_steps_of_any_size_find_the_pairs_of_one_load(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for n in range(40):
        month = rng.randrange(1, 7)
        rows.append(trip(n, 10.0 + n % 5, f"{month:02d}"))
        kind = rng.random()
        if kind < 0.3:  # reversal, in any month
            rows.append(trip(n, -(10.0 + n % 5), f"{rng.randrange(1, 7):02d}", 1))
        elif kind < 0.5:  # copy with another total, in any month
            rows.append(trip(n, 10.0 + n % 5, f"{rng.randrange(1, 7):02d}", 2, tip=rng.choice([0.0, 2.0])))
        elif kind < 0.6:  # charge, reversal and charge again is no pair
            rows += [trip(n, -(10.0 + n % 5), f"{rng.randrange(1, 7):02d}", 1), trip(n, 10.0 + n % 5, f"{rng.randrange(1, 7):02d}", 2)]
    land(spark, f"{tmp_path}/raw", rows)
    want = loaded(spark, tmp_path)
    months = len({r[-1] for r in rows})
    for step in (1, 3, 0):
        done = corrections.run_corrections(spark, f"{tmp_path}/raw", "yellow", f"{tmp_path}/out{step}", f"{tmp_path}/home{step}", harmonize.harmonize_a,
                                           catalog.adapter_dims(spark, SF), trips.ADAPTER_COLUMNS, pair_scope="load", months_per_step=step)
        assert table(spark, f"{tmp_path}/out{step}") == want
        assert sum(len(s) for s, _ in done) == months and (step == 0 or any(o for _, o in done))


def test_a_late_reversal_takes_its_charge_out_of_an_earlier_month_and_back(spark, tmp_path):
    land(spark, f"{tmp_path}/raw", [trip(1, 10.0, "01"), trip(2, 12.0, "01"), trip(3, 14.0, "02")])
    run(spark, tmp_path, "load")
    land(spark, f"{tmp_path}/raw", [trip(1, -10.0, "03", 1), trip(4, 15.0, "03")])
    assert run(spark, tmp_path, "load") == [([("1997", "03")], [("1997", "01")])]  # month 02 is left alone
    assert [r[2] for r in table(spark, f"{tmp_path}/out")] == [12.0, 14.0, 15.0]
    land(spark, f"{tmp_path}/raw", [trip(4, 15.0, "03")])  # the reversal was a mistake
    assert run(spark, tmp_path, "load") == [([("1997", "03")], [("1997", "01")])]
    assert [r[2] for r in table(spark, f"{tmp_path}/out")] == [10.0, 12.0, 14.0, 15.0]


def test_a_broken_off_run_comes_to_the_same_tables(spark, tmp_path, monkeypatch):
    land(spark, f"{tmp_path}/raw", [trip(1, 10.0, "01"), trip(2, 12.0, "02")])
    run(spark, tmp_path, "load")
    land(spark, f"{tmp_path}/raw", [trip(1, -10.0, "03", 1), trip(5, 9.0, "03")])
    with monkeypatch.context() as m:
        m.setattr(corrections.KeyState, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(spark, tmp_path, "load")
    assert run(spark, tmp_path, "load") == [([("1997", "03")], [("1997", "01")])]
    assert table(spark, f"{tmp_path}/out") == loaded(spark, tmp_path)


def test_prepare_and_complete_are_the_two_halves_of_the_curation(spark):
    cols, dims = trips.ADAPTER_COLUMNS, catalog.adapter_dims(spark, SF)
    rows = prepare(harmonize.harmonize_a(trips.read_landed(spark, SF, "a")), cols)
    kept = dedup.dedup_trips(clean.filter_both_zero(clean.filter_non_negative(dedup.remove_reversals(rows, cols), cols), cols), cols)
    a, b = shape.to_curated(complete(kept, dims, cols)), catalog.curate_trips(spark, SF)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and F and os
