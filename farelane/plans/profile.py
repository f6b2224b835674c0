"""Profiles: conditional counts, distinct values, previews, samples and
five-number (box-plot) summaries.

Exact quantiles without gathering a group: rows are first counted by (group,
value), a partial aggregate that collapses hot values.  Approximate quantiles
of the distinct values cut each group into chunks; the chunks' counts locate
the chunk that holds a wanted rank, and cumulative counts inside that chunk
alone give the value.  Ranks are found by value and count, never by row
number, so no result depends on how rows are partitioned.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.session import staged

CHECKS = {
    "zero": lambda c: F.col(c) == 0,
    "negative": lambda c: F.col(c) < 0,
    "null": lambda c: F.col(c).isNull(),
}


def profile_wide(df: DataFrame, columns: Sequence[str], checks: Sequence[str] = ("zero", "negative", "null")) -> DataFrame:
    """One row: ``<check>_<column>`` = rows failing the check (single pass)."""
    return df.agg(*[F.count_if(CHECKS[k](c)).alias(f"{k}_{c}") for c in columns for k in checks])


def profile_long(df: DataFrame, columns: Sequence[str], checks: Sequence[str] = ("negative", "zero")) -> DataFrame:
    """(column, check, bad_rows) for every column and check, from one pass."""
    wide = profile_wide(df, columns, checks)
    return wide.unpivot([], [f"{k}_{c}" for c in columns for k in checks], "metric", "bad_rows").select(
        F.regexp_extract("metric", r"^[a-z]+_(.*)$", 1).alias("column"),
        F.regexp_extract("metric", r"^([a-z]+)_", 1).alias("check"),
        F.col("bad_rows").cast("bigint").alias("bad_rows"))


def distinct_values(df: DataFrame, *exprs: Column) -> DataFrame:
    return df.select(*exprs).distinct()


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Deterministic preview: first ``n`` rows in key order (top-k; each task
    keeps its own top ``n`` before the merge)."""
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, keys: Sequence[str], percent: int = 1, seed: int = 42) -> DataFrame:
    """Sample without replacement of about ``percent`` % of the rows, by an
    md5 of the key columns: the same rows for any file layout."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.where(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100 < percent)


# -- exact quantiles ------------------------------------------------------------------

#: Chunks of a group's distinct values.
CHUNKS = 64


def _chunked_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``_g`` (struct of the groups, equal also where NULL), ``_v``, its count
    ``_n`` and its ``_chunk``.  Staged, so later steps share one copy."""
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(F.struct(*groups).alias("_g"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    counts = staged(counts, "counts")
    edges = counts.groupBy("_g").agg(F.percentile_approx("_v", [i / CHUNKS for i in range(1, CHUNKS)], 1000).alias("_edges"))
    return staged(counts.join(edges, "_g")
                  .select("_g", "_v", "_n", F.size(F.filter("_edges", lambda e: e < F.col("_v"))).alias("_chunk")), "counts")


def _quantiles(counts: DataFrame, probs: dict[str, float]) -> DataFrame:
    """``_g, n`` and the quantiles, from :func:`_chunked_counts`."""
    w = Window.partitionBy("_g")
    before = w.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = counts.groupBy("_g", "_chunk").agg(F.sum("_n").alias("_cnt"))  # CHUNKS rows a group at most
    chunks = chunks.withColumns({"_offset": F.coalesce(F.sum("_cnt").over(before), F.lit(0)), "n": F.sum("_cnt").over(w)})
    # wanted ranks: floor and ceil of p * (n - 1) for every probability
    prob_arr = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(p)).alias("p")) for k, p in probs.items()])
    wanted = (chunks.select("*", F.explode(prob_arr).alias("_q"))
                    .withColumn("_pos", F.col("_q.p") * (F.col("n") - 1))
                    .select("_g", "_chunk", "_offset", "_cnt", "n", F.col("_q.name").alias("_name"), "_pos",
                            F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_rank"))
                    .where((F.col("_rank") >= F.col("_offset")) & (F.col("_rank") < F.col("_offset") + F.col("_cnt"))))
    inside = Window.partitionBy("_g", "_chunk").orderBy("_v")
    near = (counts.join(wanted.select("_g", "_chunk").distinct(), ["_g", "_chunk"], "left_semi")
                  .withColumn("_upto", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    at = F.col("_rank") - F.col("_offset")
    found = near.join(wanted, ["_g", "_chunk"]).where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n")))
    per_prob = (found.groupBy("_g", "n", "_name", "_pos")
                     .agg(F.min_by("_v", "_rank").alias("_lo"), F.max_by("_v", "_rank").alias("_hi"))
                     .withColumn("_q", F.col("_lo") + (F.col("_pos") - F.floor("_pos")) * (F.col("_hi") - F.col("_lo"))))
    return per_prob.groupBy("_g", "n").pivot("_name", list(probs)).agg(F.first("_q"))


def group_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles (``quantile_cont``) of ``value`` per group.

    Returns ``groups + [n] + list(probs)``.  NULL values are ignored; a NULL
    group is a group.
    """
    q = _quantiles(_chunked_counts(df, groups, value), probs)
    return q.select(*[F.col(f"_g.{g}").alias(g) for g in groups], "n", *probs)


def boxplot_stats(df: DataFrame, groups: Sequence[str], value: str, digits: int = 4) -> DataFrame:
    """Five-number summary per group: n, min, q1, median, q3, max, IQR,
    whisker bounds (1.5 IQR) and the number of values outside them."""
    counts = _chunked_counts(df, groups, value)
    q = _quantiles(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumns({"lower_fence": F.col("q1") - 1.5 * F.col("iqr"), "upper_fence": F.col("q3") + 1.5 * F.col("iqr")})
    outside = (F.col("_v") < F.col("lower_fence")) | (F.col("_v") > F.col("upper_fence"))
    ends = (counts.join(q.select("_g", "lower_fence", "upper_fence"), "_g").groupBy("_g")
                  .agg(F.min("_v").alias("min"), F.max("_v").alias("max"),
                       F.sum(F.when(outside, F.col("_n")).otherwise(0)).alias("n_outliers")))
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return q.join(ends, "_g").select(
        *[F.col(f"_g.{g}").alias(g) for g in groups], F.col("n").cast("bigint").alias("n"), r("min"), r("q1"), r("median"),
        r("q3"), r("max"), r("iqr"), r("lower_fence"), r("upper_fence"), F.col("n_outliers").cast("bigint").alias("n_outliers"))


# -- mergeable quantile sketches ---------------------------------------------------------

#: Size of a sketch and the rank error to count on: a quantile's rank lies within RANK_ERROR of the one asked for
#: (the sketch's own bound at this size is 0.7 % in 99 of 100 cases).
SKETCH_K, RANK_ERROR = 400, 0.01


def month_sketches(df: DataFrame, groups: Sequence[str], value: str, months: Sequence[str] = ("file_year", "file_month"), k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch of ``value`` per month and group, a few KB whatever the
    rows.  Kept as a table, any span of months is profiled without reading
    its rows again.  NULL values are ignored; a NULL group is a group."""
    return df.groupBy(*months, *groups).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"),
                                            F.count(value).alias("n")).where("n > 0")


def sketch_quantiles(sketches: DataFrame, groups: Sequence[str], probs: dict[str, float], k: int = SKETCH_K) -> DataFrame:
    """``groups, n`` and the quantiles of all months in ``sketches``."""
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s"), F.sum("n").alias("n"))
    return merged.select(*groups, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(name) for name, p in probs.items()])
