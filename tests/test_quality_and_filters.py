"""Quality report (empty frame, failures, strict mode) and row filters."""
import pytest

from farelane.operators import clean
from farelane.plans import quality
from farelane.sources.files import curated_schema


def test_empty_frame_reports_zero_everywhere(spark):
    empty = spark.createDataFrame([], curated_schema())
    rep = quality.quality_report(empty).collect()
    assert len(rep) > 80 and all(r.bad_rows == 0 for r in rep)
    assert quality.run_gate(empty) == []


def test_gate_counts_and_strict_mode(spark):
    cols = [c.split()[0] for c in curated_schema().split(", ")]
    good = {c: None for c in cols}
    df = spark.createDataFrame([tuple(good.values())] * 2, curated_schema())
    bad = quality.run_gate(df, strict=False)
    by_check = {(c, col): n for c, col, n in bad}
    assert by_check[("null", "passenger_count")] == 2
    assert by_check[("duplicate_key", ",".join(quality.spec.QUALITY_UNIQUE_KEY))] == 1
    with pytest.raises(quality.QualityError):
        quality.run_gate(df, strict=True)


def test_null_fare_dropped_and_both_zero_dropped(spark):
    df = spark.createDataFrame([(1, 1.0, None, 5.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 1.0, 1.0), (4, 2.0, 0.0, 0.0)],
                               "id int, trip_distance double, fare_amount double, total_amount double")
    nn = sorted(r.id for r in clean.filter_non_negative(df).collect())
    assert nn == [2, 3, 4]
    bz = sorted(r.id for r in clean.filter_both_zero(clean.filter_non_negative(df)).collect())
    assert bz == [3, 4]


def test_impute_codes_and_passengers(spark):
    df = spark.createDataFrame([(None, None, None, None, None, None, None), (0, 5, 6, 1, "Y", 2, 3)],
                               "passenger_count bigint, PULocationID int, DOLocationID int, RatecodeID bigint, "
                               "store_and_fwd_flag string, payment_type bigint, trip_type int")
    out = clean.impute_codes(clean.impute_passengers(df)).collect()
    assert tuple(out[0]) == (1, 264, 264, 99, "N", 5, 3)
    assert tuple(out[1]) == (1, 5, 6, 1, "Y", 2, 3)


def test_charges_under_any_spelling_count(spark):
    from farelane.operators import harmonize
    df = spark.createDataFrame([(10.0, 1.25, 1)], "fare_amount double, airport_fee double, passenger_count int")
    out = clean.impute_zero(clean.recompute_total(harmonize.canonical(df)).withColumn("trip_distance", clean.F.lit(None).cast("double")))
    r = out.first()
    assert (r.total_amount, r.Airport_fee, r.cbd_congestion_fee, r.trip_distance) == (11.25, 1.25, 0.0, 0.0)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):  # an absent component is an error, never left out
        clean.recompute_total(df.select("fare_amount")).collect()
