"""Row measures (duration, ratios) and rule-based outlier flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane import spec
from farelane.functions import columns as X
from farelane.spec import DEFAULT_COLUMNS, TripColumns


def add_duration(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS,
                 name: str = "trip_duration_min") -> DataFrame:
    return df.withColumn(name, X.duration_minutes(cols.pickup, cols.dropoff))


def add_ratios(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, zero_divisor: str = "null") -> DataFrame:
    """miles/min, miles/hour, fare/mile, fare/min.  ``zero_divisor='null'``
    (curation) gives NULL for a 0 or NULL divisor, ``'zero'`` (exploration
    variant) gives 0."""
    ratio = X.safe_ratio if zero_divisor == "null" else X.ratio_or_zero
    dur = "trip_duration_min"
    return (df.withColumn("miles_per_minute", ratio(cols.distance, dur))
              .withColumns({"miles_per_hour": F.col("miles_per_minute") * 60,
                            "fare_amount_per_mile": ratio(cols.fare, cols.distance),
                            "fare_amount_per_min": ratio(cols.fare, dur)}))


def add_measures(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, zero_divisor: str = "null") -> DataFrame:
    return add_ratios(add_duration(df, cols), cols, zero_divisor)


def trip_outlier_rule(distance="trip_distance", duration="trip_duration_min", mpm="miles_per_minute"):
    rules = [(F.col(mpm) < spec.TRIP_MPM_LOW) | (F.col(mpm) > spec.TRIP_MPM_HIGH)]
    for dop, dist, top, minutes in spec.TRIP_DISTANCE_DURATION_RULES:
        rules.append(X.compare(distance, dop, dist) & X.compare(duration, top, minutes))
    return X.any_rule(rules)


def fare_outlier_rule(per_mile="fare_amount_per_mile", per_min="fare_amount_per_min"):
    return X.any_rule([
        (F.col(per_mile) < spec.FARE_PER_MILE_LOW) | (F.col(per_mile) > spec.FARE_PER_MILE_HIGH),
        (F.col(per_min) < spec.FARE_PER_MIN_LOW) | (F.col(per_min) > spec.FARE_PER_MIN_HIGH),
        F.col(per_min) == 0,
    ])


def flag_trip_outlier(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    return df.withColumn("trip_outlier_flag", trip_outlier_rule(cols.distance))


def flag_fare_outlier(df: DataFrame) -> DataFrame:
    return df.withColumn("fare_amount_outlier_flag", fare_outlier_rule())


def flag_outliers(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    return flag_fare_outlier(flag_trip_outlier(df, cols))
