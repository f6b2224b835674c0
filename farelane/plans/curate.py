"""The curation plan: harmonised raw trips -> 44-column curated trips.

Logical order (each step an operator of :mod:`farelane.operators`):
recompute total -> year repair + clamp -> remove reversal pairs -> drop
negative / both-zero rows -> keep best duplicate -> impute -> (re-clamp,
date parts) -> code and zone lookups -> measures -> outlier flags -> layout.

Physical plan (``plan="fused"``, the default)::

    raw --> rows whose 6 keys a row with a total of 0 or less has (bitmaps)
          -> partial agg(6 keys: n, sum, min/max fare) --exchange--> final agg
          -> pair members (6 keys + fare), small
    raw --> 7-key hashes that two rows or a pair member have --> bitmaps; rows
            that miss them are neither in a pair nor duplicates and are not
            shuffled, however many share their 6 keys; the others:
            filters -> partial top-1 per 7 keys --exchange(7 keys)--> top-1
              -> left-anti join members on the 7 keys (only members shuffle)
    both -> impute / broadcast lookups / measures / flags (narrow)

Removing pairs after keep-best is exact: a pair group on the six keys is
removed whole, duplicate groups nest inside it, and a surviving row always
carries one of the two member fares.  Every shuffle is preceded by a
map-side reduction, so a key holding a third of the rows never lands whole
in one task.  ``plan="window"`` computes the pair test with window aggregates
on the same exchange as keep-best (one scan, one shuffle), for data known to
have no hot key.  ``plan="pruned"`` has the key filter before the pair shuffle, but sends every
row through keep-best.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators import clean, dedup, enrich, measures, shape
from farelane.session import staged
from farelane.spec import DEFAULT_COLUMNS, TripColumns


def _remove_pairs_and_duplicates(df: DataFrame, cols: TripColumns, plan: str, arranged: bool = False) -> DataFrame:
    if plan == "window":
        df = dedup.drop_reversals_windowed(df, cols)
        return dedup.dedup_trips(not_dropped(df, cols), cols)
    if plan == "pruned":
        return _fused(df, cols, prune=True)
    members, alone, together = apart(df, cols)
    kept = _best_without(members, together, cols)
    if arranged:  # the others lie as they were read: by month file
        kept = kept.hint("rebalance", cols.file_year, cols.file_month)
    return kept if alone is None else not_dropped(alone, cols).unionByName(kept)


def apart(df: DataFrame, cols: TripColumns) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """``df`` as (pair members, alone, together): only rows ``together`` may be
    in a pair or have duplicates (``alone`` is None where these are too many
    to tell apart).  Many rows may share the pair keys and differ in fare, so
    pairs are found first, from the narrow rows that may form one."""
    narrow = df.select(*cols.reversal_keys, cols.total, cols.fare)
    members = dedup.reversal_members(staged(dedup.pair_candidates(narrow, cols, nulls=True), "pair-candidates"), cols)
    named = members.select(F.xxhash64(*cols.dedup_keys).alias("_h"))
    return members, *dedup.split_shared(df, cols.dedup_keys, named)


def not_dropped(df: DataFrame, cols: TripColumns) -> DataFrame:
    return clean.filter_both_zero(clean.filter_non_negative(df, cols), cols)


def _fused(df: DataFrame, cols: TripColumns, prune: bool = False) -> DataFrame:
    return _best_without(dedup.reversal_members(df, cols, prune=prune), df, cols)


def _best_without(members: DataFrame, df: DataFrame, cols: TripColumns) -> DataFrame:
    kept = dedup.dedup_trips(not_dropped(df, cols), cols)
    return kept.join(members, on=list(cols.dedup_keys), how="left_anti").select(*df.columns)


def prepare(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Harmonised raw trips with their totals and timestamps in order: the
    rows in which pairs and duplicates are searched."""
    return clean.repair_timestamps(clean.recompute_total(df, cols), cols)


#: For runs that publish month by month.
remove_pairs_and_duplicates = _remove_pairs_and_duplicates


def complete(df: DataFrame, dims: dict[str, DataFrame], cols: TripColumns = DEFAULT_COLUMNS, zone_key: str = "LocationID") -> DataFrame:
    """The rows kept of the prepared ones: imputed, looked up and measured.
    NULL timestamps are filled from the file month and the clamp and date
    parts are computed after that fill, so filled rows get date parts too."""
    df = clean.impute_passengers(df, cols)
    df = clean.impute_zero(df, cols)
    df = clean.impute_codes(df, cols)
    df = clean.impute_timestamps(df, cols)
    df = clean.clamp_end(df, cols)
    df = clean.add_date_parts(df, cols)
    df = enrich.enrich_trips(df, dims["ratecode"], dims["payment_type"], dims["zone"], zone_key=zone_key)
    df = measures.add_measures(df, cols)
    return measures.flag_outliers(df, cols)


def curate_columns(df: DataFrame, dims: dict[str, DataFrame], cols: TripColumns = DEFAULT_COLUMNS,
                   plan: str = "fused", zone_key: str = "LocationID", arranged: bool = False) -> DataFrame:
    """Harmonised raw trips (with file_year / file_month) -> every curated
    column under its source name (before the curated layout).

    ``dims`` needs ``ratecode``, ``payment_type`` and ``zone``.  ``arranged``
    rows lie by month, for a writer that then shuffles none of the wide rows.
    """
    kept = _remove_pairs_and_duplicates(prepare(df, cols), cols, plan, arranged)
    return complete(kept, dims, cols, zone_key)


def curate(df: DataFrame, dims: dict[str, DataFrame], cols: TripColumns = DEFAULT_COLUMNS,
           plan: str = "fused", zone_key: str = "LocationID", timestamp_type: str = "ntz", arranged: bool = False) -> DataFrame:
    """Harmonised raw trips -> the 44-column curated trips.  ``timestamp_type``
    ``"ltz"`` emits session-zone TIMESTAMP columns instead of TIMESTAMP_NTZ."""
    return shape.to_curated(curate_columns(df, dims, cols, plan, zone_key, arranged), timestamp_type=timestamp_type)
