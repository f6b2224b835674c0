"""Row-level repairs (totals, timestamps, imputation) and row filters."""

from __future__ import annotations

from functools import reduce
import operator
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane import spec
from farelane.functions import columns as X
from farelane.spec import DEFAULT_COLUMNS, TripColumns


# -- totals ------------------------------------------------------------------

def recompute_total(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """total := sum of the charge components, NULL read as 0 (overwrites).
    Every component must exist (see ``harmonize.canonical``)."""
    return df.withColumn(cols.total, X.sum_null_as_zero(cols.total_components).cast("double"))


def recompute_total_strict(df: DataFrame, components: Sequence[str] = spec.STRICT_TOTAL_COMPONENTS,
                           target: str = "total_amount") -> DataFrame:
    """Exploration variant: NULL-propagating sum."""
    return df.withColumn(target, X.sum_strict(components))


# -- timestamps ----------------------------------------------------------------

def _file_year_int(cols: TripColumns):
    return F.col(cols.file_year).try_cast("int")


def repair_start_year(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Pickup moved into the file year unless it is a New-Year crossing."""
    return df.withColumn(cols.pickup, X.repaired_start(cols.pickup, cols.dropoff, _file_year_int(cols)))


def repair_end_year(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Dropoff moved into the file year, judged against the (repaired) pickup."""
    return df.withColumn(cols.dropoff, X.repaired_end(cols.pickup, cols.dropoff, _file_year_int(cols)))


def clamp_end(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """dropoff earlier than pickup -> dropoff := pickup."""
    return df.withColumn(cols.dropoff, X.clamped_end(cols.pickup, cols.dropoff))


def repair_timestamps(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Year repair of both ends, then the clamp, as one projection."""
    fy = _file_year_int(cols)
    start = X.repaired_start(cols.pickup, cols.dropoff, fy)
    end = X.repaired_end(start, cols.dropoff, fy)
    # Two steps keep the expression tree small: the clamp reads the
    # projected columns instead of re-inlining both CASE trees.
    return (df.withColumns({cols.pickup: start, cols.dropoff: end})
              .withColumn(cols.dropoff, X.clamped_end(cols.pickup, cols.dropoff)))


DATE_PART_NAMES = ("pickup_year", "pickup_month", "pickup_day",
                   "dropoff_year", "dropoff_month", "dropoff_day")


def add_date_parts(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """year / month / day of pickup and dropoff."""
    p, d = F.col(cols.pickup), F.col(cols.dropoff)
    return df.withColumns({
        "pickup_year": F.year(p), "pickup_month": F.month(p), "pickup_day": F.dayofmonth(p),
        "dropoff_year": F.year(d), "dropoff_month": F.month(d), "dropoff_day": F.dayofmonth(d),
    })


# -- imputation ------------------------------------------------------------------

def impute_passengers(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """passenger_count NULL or 0 -> 1."""
    p = F.col(cols.passengers)
    return df.withColumn(
        cols.passengers,
        F.when(p.isNull() | (p == 0), F.lit(spec.DEFAULT_PASSENGERS)).otherwise(p))


def impute_zero(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """NULL charge/distance -> 0."""
    return df.withColumns({x: F.coalesce(F.col(x), F.lit(0)) for x in cols.zero_fill})


def impute_codes(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """NULL code -> its 'unknown' code."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in cols.code_defaults.items()})


def impute_timestamps(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """NULL pickup/dropoff -> first instant of the file month."""
    start = X.month_start(cols.file_year, cols.file_month)
    return df.withColumns({cols.pickup: F.coalesce(F.col(cols.pickup), start),
                           cols.dropoff: F.coalesce(F.col(cols.dropoff), start)})


# -- filters -------------------------------------------------------------------------

def filter_non_negative(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """distance >= 0 AND fare >= 0 AND total >= 0 (NULLs are dropped)."""
    return df.filter((F.col(cols.distance) >= 0) & (F.col(cols.fare) >= 0) & (F.col(cols.total) >= 0))


def filter_both_zero(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop rows whose distance and total are both not positive."""
    return df.filter((F.col(cols.distance) > 0) | (F.col(cols.total) > 0))


def trip_band(distance="trip_distance", duration="trip_duration_min", mpm="miles_per_minute"):
    """Predicate of the exploration trip band (keeps plausible trips only)."""
    keep = (F.col(mpm) <= spec.TRIP_MPM_HIGH) & (F.col(mpm) >= spec.TRIP_MPM_LOW)
    for dop, dist, top, minutes in spec.TRIP_DISTANCE_DURATION_RULES:
        keep = keep & ~(X.compare(distance, dop, dist) & X.compare(duration, top, minutes))
    return keep


def fare_band(per_mile="fare_amount_per_mile", per_min="fare_amount_per_min"):
    """Predicate of the exploration fare band."""
    return ((F.col(per_mile) <= spec.FARE_PER_MILE_HIGH) & (F.col(per_mile) >= spec.FARE_PER_MILE_LOW)
            & (F.col(per_min) <= spec.FARE_PER_MIN_HIGH) & (F.col(per_min) >= spec.FARE_PER_MIN_LOW))


def filter_outlier_bands(df: DataFrame, kind: str = "trip") -> DataFrame:
    """Keep only rows inside the band; NULL ratios are dropped."""
    return df.filter(trip_band() if kind == "trip" else fare_band())


def point_lookup(df: DataFrame, equalities: dict) -> DataFrame:
    """Conjunctive equality lookup (pushed into the Parquet scan)."""
    return df.filter(reduce(operator.and_, [F.col(k) == F.lit(v) for k, v in equalities.items()]))


def exception_rows(df: DataFrame, amount: str, moved: str, code: str,
                   excluded_codes: Sequence = (3, 4)) -> DataFrame:
    """Zero amount although something moved, outside the excused codes."""
    return df.filter((F.col(amount) == 0) & (F.col(moved) != 0) & ~F.col(code).isin(*excluded_codes))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def negative_duration(df: DataFrame, duration: str = "trip_duration_min") -> DataFrame:
    return df.filter(F.col(duration) < 0)
