"""Year repair, clamp, month fill (unit frames)."""
from pyspark.sql import functions as F

from frames import ts
from farelane.operators import clean

SCHEMA = "file_year string, file_month string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz"


def _repair(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = clean.repair_timestamps(df)
    return [(r.pickup_datetime, r.dropoff_datetime) for r in out.collect()]


def test_new_year_crossing_into_file_year_is_kept(spark):
    got = _repair(spark, [("2024", "01", ts("2023-12-31 23:50:00"), ts("2024-01-01 00:10:00"))])
    assert got == [(ts("2023-12-31 23:50:00"), ts("2024-01-01 00:10:00"))]


def test_new_year_crossing_out_of_file_year_is_kept(spark):
    got = _repair(spark, [("2024", "12", ts("2024-12-31 23:50:00"), ts("2025-01-01 00:10:00"))])
    assert got == [(ts("2024-12-31 23:50:00"), ts("2025-01-01 00:10:00"))]


def test_wrong_year_is_replaced_keeping_the_rest(spark):
    got = _repair(spark, [("2024", "05", ts("2009-05-05 10:11:12"), ts("2009-05-05 10:31:00"))])
    assert got == [(ts("2024-05-05 10:11:12"), ts("2024-05-05 10:31:00"))]


def test_whole_trip_on_previous_new_years_eve_moves_forward(spark):
    # kept behaviour: both ends move to 31 Dec of the file year
    got = _repair(spark, [("2024", "01", ts("2023-12-31 10:00:00"), ts("2023-12-31 10:20:00"))])
    assert got == [(ts("2024-12-31 10:00:00"), ts("2024-12-31 10:20:00"))]


def test_leap_day_into_common_year_becomes_null_then_month_start(spark):
    df = spark.createDataFrame([("2023", "02", ts("2024-02-29 08:00:00"), ts("2024-02-29 08:30:00"))], SCHEMA)
    rep = clean.repair_timestamps(df)
    assert rep.first().pickup_datetime is None
    filled = clean.impute_timestamps(rep).first()
    assert filled.pickup_datetime == ts("2023-02-01 00:00:00")
    assert filled.dropoff_datetime == ts("2023-02-01 00:00:00")


def test_sub_second_part_is_dropped_on_rebuild(spark):
    got = _repair(spark, [("2024", "03", ts("2020-03-03 01:02:03.456"), ts("2024-03-03 01:12:00"))])
    assert got[0][0] == ts("2024-03-03 01:02:03")


def test_clamp_is_null_preserving(spark):
    df = spark.createDataFrame([("2024", "01", ts("2024-01-02 10:00:00"), ts("2024-01-02 09:00:00")),
                                ("2024", "01", None, ts("2024-01-02 09:00:00"))], SCHEMA)
    out = [(r.pickup_datetime, r.dropoff_datetime) for r in clean.clamp_end(df).collect()]
    assert out == [(ts("2024-01-02 10:00:00"), ts("2024-01-02 10:00:00")), (None, ts("2024-01-02 09:00:00"))]


def test_invalid_file_year_does_not_fail_the_job(spark):
    got = _repair(spark, [("", "", ts("2024-01-02 10:00:00"), ts("2024-01-02 10:30:00"))])
    assert got == [(None, None)]


def test_duration_is_whole_seconds(spark):
    from farelane.operators import measures
    df = spark.createDataFrame([("2024", "01", ts("2024-01-01 00:00:00.900"), ts("2024-01-01 00:01:00.100"))], SCHEMA)
    assert measures.add_duration(df).first().trip_duration_min == 1.0
    assert F is not None


def test_curated_layout_can_emit_session_zone_timestamps(spark):
    from farelane.operators import shape
    from farelane.sources.files import curated_schema
    df = spark.createDataFrame([], curated_schema())
    assert dict(shape.cast_layout(df).dtypes)["pickup_datetime"] == "timestamp_ntz"
    assert dict(shape.cast_layout(df, timestamp_type="ltz").dtypes)["pickup_datetime"] == "timestamp"
