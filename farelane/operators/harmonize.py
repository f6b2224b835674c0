"""Flavour harmonisation: bring yellow-shaped (A) and green-shaped (B) raw
trips to the common column set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane import spec


def canonical(df: DataFrame, charges=spec.TOTAL_COMPONENTS) -> DataFrame:
    """Charge columns under their one spelling (file vintages differ in case,
    and column names are matched without it); absent ones as typed NULL.
    Later steps name every charge unconditionally, so none is ever skipped."""
    have = {c.lower(): c for c in df.columns}
    df = df.withColumnsRenamed({have[c.lower()]: c for c in charges if have.get(c.lower(), c) != c})
    return df.withColumns({c: F.lit(None).cast("double") for c in charges if c.lower() not in have})


def harmonize_a(df: DataFrame) -> DataFrame:
    """Flavour A: no e-hail fee (typed NULL), fixed trip type, tpep_* names."""
    start, end = spec.FLAVOUR_A_TIMESTAMPS
    df = df.withColumns({"ehail_fee": F.lit(None).cast("double"),
                         "trip_type": F.lit(spec.FLAVOUR_A_TRIP_TYPE)})
    return canonical(df.withColumnsRenamed({start: "pickup_datetime", end: "dropoff_datetime"}))


def harmonize_b(df: DataFrame) -> DataFrame:
    """Flavour B: no airport fee (typed NULL), lpep_* names."""
    start, end = spec.FLAVOUR_B_TIMESTAMPS
    df = canonical(df.withColumnsRenamed({start: "pickup_datetime", end: "dropoff_datetime"}))
    return df.withColumn("Airport_fee", F.lit(None).cast("double"))
