"""Other forms of pair removal + keep-best, to compare the plans with."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions import columns as X
from farelane.operators import clean, dedup
from farelane.plans.curate import _remove_pairs_and_duplicates
from farelane.spec import DEFAULT_COLUMNS, TripColumns


def apply(df: DataFrame, cols: TripColumns, plan: str) -> DataFrame:
    if plan == "literal":  # aggregate + anti join, then the window
        df = clean.filter_both_zero(clean.filter_non_negative(dedup.remove_reversals(df, cols), cols), cols)
        return dedup.dedup_trips(df, cols)
    if plan == "single":
        f = F.col
        keep = ((f(cols.distance) >= 0) & (f(cols.fare) >= 0) & (f(cols.total) >= 0)
                & ((f(cols.distance) > 0) | (f(cols.total) > 0)))
        return best_without_pairs(df, keep, cols)
    return _remove_pairs_and_duplicates(df, cols, plan)


def best_without_pairs(df: DataFrame, keep, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Pair removal + keep-best from a single scan.

    One partial aggregate on the seven keys keeps, per group, the row count,
    the total sum and the best row among those satisfying ``keep`` (a row
    filter applied before keep-best).  Pair statistics on the six keys are
    sums over these summaries (a pair group has two rows, so its total is
    exact).  The pair members' fares come from the summaries' fare key, and
    the anti join on the seven keys reuses the summaries' partitioning.
    """
    keys7, keys6 = list(cols.dedup_keys), list(cols.reversal_keys)
    tiebreak = cols.tiebreak or [x for x in df.columns if x not in keys7 and x != cols.total]
    order = F.struct(F.col(cols.total).isNull(), -F.col(cols.total), *[F.col(t) for t in tiebreak])
    row = F.struct(*[F.col(c) for c in df.columns])
    summary = df.groupBy(*keys7).agg(F.count(F.lit(1)).alias("_n"), F.sum(cols.total).alias("_s"),
                                     F.min_by(row, F.when(keep, order)).alias("_best"))
    pairs = (summary.groupBy(*keys6)
                    .agg(F.sum("_n").alias("_n6"), F.sum("_s").alias("_s6"),
                         F.min(cols.fare).alias("_f1"), F.max(cols.fare).alias("_f2"))
                    .filter((F.col("_n6") == 2) & (F.col("_s6") == 0) & X.all_not_null(keys6)))
    members = (pairs.select(*keys6, F.explode(F.array_distinct(F.array("_f1", "_f2"))).alias(cols.fare))
                    .filter(F.col(cols.fare).isNotNull()))
    kept = summary.filter(F.col("_best").isNotNull()).join(members, on=keys7, how="left_anti")
    return kept.select("_best.*")
