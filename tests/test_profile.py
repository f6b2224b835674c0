"""Exact quantiles without gathering a group, conditional counts."""
import numpy as np
from pyspark.sql import functions as F

from farelane.plans import profile


def test_group_quantiles_match_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(7)
    values = rng.normal(size=3000).round(3)
    groups = np.where(np.arange(3000) % 3 == 0, "b", "a")  # 'a' holds two thirds
    groups[:5] = "c"
    pdf = {"g": groups.tolist(), "v": values.tolist()}
    df = spark.createDataFrame(list(zip(pdf["g"], pdf["v"])), "g string, v double").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {r.g: r for r in profile.group_quantiles(df, ["g"], "v", {"q1": .25, "median": .5, "q3": .75}).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for g in ("a", "b", "c"):
        x = values[groups == g]
        assert got[g].n == len(x)
        for name, p in (("q1", .25), ("median", .5), ("q3", .75)):
            assert abs(got[g][name] - np.quantile(x, p)) < 1e-9


def test_boxplot_outliers(spark):
    df = spark.createDataFrame([("k", float(v)) for v in [1, 2, 3, 4, 100]], "k string, v double")
    r = profile.boxplot_stats(df, ["k"], "v").first()
    assert (r.q1, r.median, r.q3, r.n_outliers, r.max) == (2.0, 3.0, 4.0, 1, 100.0)


def test_profile_wide_and_long(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (2.0,)], "x double")
    w = profile.profile_wide(df, ["x"]).first()
    assert (w.zero_x, w.negative_x, w.null_x) == (1, 1, 1)
    long = {(r.column, r.check): r.bad_rows for r in profile.profile_long(df, ["x"]).collect()}
    assert long == {("x", "negative"): 1, ("x", "zero"): 1}
    assert F is not None


def test_null_group_hot_value_and_no_exchange_reuse(spark):
    rows = [(None if i % 4 == 0 else "a", 5.0 if i % 3 == 0 else float(i % 701)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r.g: r for r in profile.boxplot_stats(df, ["g"], "v").collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert set(got) == {None, "a"}
    for g, r in got.items():
        x = np.array([v for k, v in rows if k == g])
        q1, q2, q3 = np.quantile(x, [.25, .5, .75])
        assert (r.n, r.min, r.max) == (len(x), x.min(), x.max())
        assert np.allclose([r.q1, r.median, r.q3], [q1, q2, q3])
        assert r.n_outliers == ((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))).sum()


def test_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 7).alias("x"))
    a, b = (sorted(r.id for r in profile.sample_rows(d, ["id"], 3).collect()) for d in (df.repartition(1), df.repartition(9, "x")))
    assert a == b and 450 < len(a) < 750
