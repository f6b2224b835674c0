"""Schema-level shaping: rename + reorder + cast to the curated layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane import spec


def rename_reorder(df: DataFrame, layout=spec.CURATED_COLUMNS) -> DataFrame:
    """One projection: source names -> curated names, in curated order
    (columns outside the layout are dropped)."""
    return df.select(*[F.col(src).alias(dst) for src, dst, _ in layout])


def _target(t: str, timestamp_type: str) -> str:
    if t != "timestamp":
        return t
    return "timestamp_ntz" if timestamp_type == "ntz" else "timestamp"


def cast_layout(df: DataFrame, layout=spec.CURATED_COLUMNS, timestamp_type: str = "ntz") -> DataFrame:
    """Cast every curated column to its declared type (one projection).
    Timestamps stay wall-clock (TIMESTAMP_NTZ) unless ``timestamp_type="ltz"``
    asks for session-zone TIMESTAMP (the wall clock is read in the session
    time zone)."""
    return df.select(*[F.col(dst).cast(_target(t, timestamp_type)).alias(dst) for _, dst, t in layout])


def to_curated(df: DataFrame, layout=spec.CURATED_COLUMNS, timestamp_type: str = "ntz") -> DataFrame:
    """Rename, reorder and cast in a single projection."""
    return df.select(*[F.col(src).cast(_target(t, timestamp_type)).alias(dst) for src, dst, t in layout])


def cast_or_reject(df: DataFrame, layout=spec.CURATED_COLUMNS, timestamp_type: str = "ntz") -> DataFrame:
    """As :func:`cast_layout`, but a value that its type refuses becomes NULL
    and its column is named in ``failed_columns``, its text in
    ``failed_values`` (arrays in column order, empty for a good row), instead
    of failing the whole table.  One projection: a write partitioned by
    :func:`is_reject` splits good and rejected rows in one pass."""
    kinds = {dst: _target(t, timestamp_type) for _, dst, t in layout}
    cast = {c: F.col(c).try_cast(t) for c, t in kinds.items()}
    bad = [F.when(F.col(c).isNotNull() & v.isNull(), F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))) for c, v in cast.items()]
    marked = df.withColumn("_bad", F.filter(F.array(*bad), lambda x: x.isNotNull()))
    return marked.select(*[v.alias(c) for c, v in cast.items()], F.col("_bad.name").alias("failed_columns"), F.col("_bad.value").alias("failed_values"))


def is_reject() -> Column:
    return F.size("failed_columns") > 0
