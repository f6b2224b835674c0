"""Publication calendar: which monthly files should exist, and which are missing.

Files are published with a lag (``PUBLICATION_LAG_MONTHS``): until that lag
has passed in a new year, the year list stops at the previous year.  Every
month of every listed year is expected for every vehicle; the missing ones
are the expected months without an observed file.  ``as_of`` is data
(e.g. the latest event date), never the wall clock.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane import spec


def bounds(spark: SparkSession, as_of: str, first_year: int = spec.FIRST_PUBLISHED_YEAR) -> DataFrame:
    """One-row bounds frame for a scheduled run: first published year and the
    run date (``yyyy-mm-dd``, passed in by the scheduler)."""
    return spark.createDataFrame([(first_year, as_of)], "first_year int, as_of string").select(
        "first_year", F.to_date("as_of").alias("as_of"))


def horizon_year(as_of: Column, lag_months: int = spec.PUBLICATION_LAG_MONTHS) -> Column:
    return F.year(F.add_months(as_of.cast("date"), -lag_months))


def publication_years(bounds: DataFrame, first_year: str = "first_year", as_of: str = "as_of",
                      lag_months: int = spec.PUBLICATION_LAG_MONTHS) -> DataFrame:
    """One row per published year, from a one-row frame of bounds."""
    return bounds.select(F.explode(F.sequence(F.col(first_year).cast("int"),
                                              horizon_year(F.col(as_of), lag_months))).alias("year"))


def expected_months(bounds: DataFrame, vehicles: Sequence[str] = spec.VEHICLES,
                    first_year: str = "first_year", as_of: str = "as_of",
                    lag_months: int = spec.PUBLICATION_LAG_MONTHS) -> DataFrame:
    """(vehicle, year, month) for every vehicle, published year and month."""
    years = publication_years(bounds, first_year, as_of, lag_months)
    return (years.select(F.explode(F.array(*[F.lit(v) for v in vehicles])).alias("vehicle"), "year")
                 .select("vehicle", "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")))


def missing_months(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected (vehicle, year, month) without an observed file."""
    return expected.join(observed.select("vehicle", "year", "month").distinct(),
                         on=["vehicle", "year", "month"], how="left_anti")
