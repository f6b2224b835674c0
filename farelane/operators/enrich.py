"""Dimension lookups.  Spark broadcasts a dimension when its size is known to
be below ``spark.sql.autoBroadcastJoinThreshold`` (bytes), at planning or, by
AQE, once it is measured; a larger one is joined by shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left equi join ``USING (key)``: adds the dimension's other columns."""
    return df.join(dim, on=key, how="left")


def role_join(df: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, prefix: str) -> DataFrame:
    """Left join of one dimension in a role: dimension columns are renamed
    ``<prefix><name>`` before the join and the dimension key is dropped."""
    renamed = dim.select(F.col(dim_key).alias("_role_key"),
                         *[F.col(x).alias(prefix + x) for x in dim.columns if x != dim_key])
    joined = df.join(renamed, df[fact_key] == F.col("_role_key"), "left")
    return joined.drop("_role_key")


def enrich_trips(df: DataFrame, ratecode: DataFrame, payment_type: DataFrame,
                 zone: DataFrame, trip_type: DataFrame | None = None,
                 zone_key: str = "LocationID") -> DataFrame:
    """Code descriptions and pickup/dropoff zones.  The trip-type lookup is
    optional: the curated projection drops its result, and Catalyst cannot
    remove an unused left join on a key not known to be unique."""
    out = lookup_join(df, ratecode, "RatecodeID")
    out = lookup_join(out, payment_type, "payment_type")
    if trip_type is not None:
        out = lookup_join(out, trip_type, "trip_type")
    out = role_join(out, zone, "PULocationID", zone_key, "PU_")
    return role_join(out, zone, "DOLocationID", zone_key, "DO_")
