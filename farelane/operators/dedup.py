"""Grouping operators: reversal pairs, duplicate keys, keep-best de-duplication.

Skew: every operator here either aggregates with a map-side partial
aggregate, or (keep-best) lets Spark apply a partial per-group limit before
the shuffle, so a key holding a large share of the rows is reduced on the
map side instead of being sent whole to one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions import columns as X
from farelane.session import staged
from farelane.spec import DEFAULT_COLUMNS, TripColumns


def reversal_groups(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Groups on the reversal keys with exactly two rows whose totals cancel."""
    keys = list(cols.reversal_keys)
    return (df.groupBy(*keys)
              .agg(F.sum(cols.total).alias("total_amount_sum"), F.count(F.lit(1)).alias("count"))
              .filter((F.col("total_amount_sum") == 0) & (F.col("count") == 2)))


#: Bits of the key filter for each row that it holds, and its size at most (128 MB; it is broadcast).
FILTER_BITS, FILTER_LIMIT = 8, 1 << 30


def pair_candidates(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, limit: int = FILTER_LIMIT, nulls: bool = False) -> DataFrame:
    """The rows of ``df`` whose pair keys may form a pair, before any shuffle.

    Two totals that cancel are not both positive.  The key hashes of the rows
    with a total of 0 or less set the bits of a filter, whose size follows
    their number; it is broadcast, as small bitmaps, and only rows whose bit
    is set go on.  All rows of a key go on or none, so groups stay whole; a
    bit shared by chance keeps rows that the aggregate then rejects.  Where
    the filter would be larger than ``limit`` bits, every row goes on.
    ``nulls``: keys with a NULL part are left to the aggregate to reject."""
    keys = list(cols.reversal_keys)
    whole = X.all_not_null(keys)
    low = df.where((F.col(cols.total) <= 0) & whole)
    bitmaps = key_bitmaps(staged(low.select(F.xxhash64(*keys).alias("_h")), "low-keys"), limit)
    if bitmaps is None:
        return df
    return (df if nulls else df.where(whole)).join(F.broadcast(bitmaps.rows), bitmaps.bucket(keys)).where(bitmaps.hit(keys)).select(*df.columns)


class KeyBitmaps:
    """A set of key hashes as bitmaps of 512 bytes (``_bucket, _words``: 64
    words), to be broadcast.  Keys that are in the set always hit; others do by
    chance.  The bitmaps are small as a wide stage, which Spark does not
    compile as a whole, copies one for every row; no part of the condition
    may be NULL, or Spark would work out the keys a second time to filter on it."""

    def __init__(self, rows: DataFrame, bits: int):
        self.rows, self.bits = rows, bits

    def _place(self, keys: Sequence[str]) -> Column:
        return F.xxhash64(*keys).bitwiseAND(F.lit(self.bits - 1))  # a power of two

    def bucket(self, keys: Sequence[str]) -> Column:
        return F.shiftright(self._place(keys), 12) == F.col("_bucket")

    def hit(self, keys: Sequence[str]) -> Column:
        """Whether the bit of the keys is set in ``_words`` (NULL: no bitmap met)."""
        at = self._place(keys).bitwiseAND(F.lit(4095)).cast("int")
        in_word = 56 - F.shiftright(at, 3).bitwiseAND(7) * 8 + at.bitwiseAND(7)  # a word's first byte is its highest
        return F.getbit(F.get("_words", F.shiftright(at, 6)), in_word) != 0


def key_bitmaps(hashes: DataFrame, limit: int = FILTER_LIMIT) -> KeyBitmaps | None:
    """The bitmaps of ``hashes`` (``_h``, read twice), of a size that follows
    their number; None where that is above ``limit`` bits."""
    bits = 1 << max(15, (FILTER_BITS * hashes.count()).bit_length())
    if bits > limit:
        return None
    place = F.col("_h").bitwiseAND(F.lit(bits - 1)) + 1  # Spark's bitmaps count from 1
    built = (hashes.select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("_bucket"))
                   .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits")))
    parts = built.select("_bucket", "_bits", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_part"))
    word = lambda i: F.conv(F.hex(F.substring(F.col("_bits"), F.col("_part") * 512 + i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return KeyBitmaps(parts.select(((F.col("_bucket") - 1) * 8 + F.col("_part")).alias("_bucket"),
                                   F.transform(F.sequence(F.lit(0), F.lit(63)), word).alias("_words")), bits)


def shared_hashes(keys_and_rows: DataFrame, keys: Sequence[str], rows: str | None = None) -> DataFrame:
    """``_h``: hashes of the ``keys`` that more than one row has (``rows``: a
    column that says how many rows each stands for).  Only hashes are shuffled."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return keys_and_rows.groupBy(F.xxhash64(*keys).alias("_h")).agg(n.alias("_n")).where("_n > 1").select("_h")


def split_shared(df: DataFrame, keys: Sequence[str], extra: DataFrame | None = None, limit: int = FILTER_LIMIT) -> tuple[DataFrame | None, DataFrame]:
    """``df`` as (alone, together): every row whose ``keys`` another row has is
    in ``together``, whole groups at a time (NULL equals NULL); of the others
    all but a few are in ``alone`` and need no shuffle to know that nothing
    equals them.  ``extra`` hashes (``_h``) send their rows to ``together`` too.
    Without ``alone`` (None) where the shared keys are too many to broadcast:
    ``together`` is then ``df``."""
    shared = shared_hashes(df, keys)
    shared = staged(shared if extra is None else shared.unionByName(extra), "shared-keys")
    bitmaps = key_bitmaps(shared, limit)
    if bitmaps is None:
        return None, df
    bitmaps = KeyBitmaps(bitmaps.rows.checkpoint(), bitmaps.bits)  # 128 MB at most
    hit = F.coalesce(bitmaps.hit(keys), F.lit(False))
    met = df.join(F.broadcast(bitmaps.rows), bitmaps.bucket(keys), "left")
    return met.where(~hit).select(*df.columns), staged(met.where(hit).select(*df.columns), "together")


def remove_reversals(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop both rows of every reversal pair (left-anti join on the six keys;
    pairs with a NULL key part never match, exactly as an equi-join)."""
    keys = list(cols.reversal_keys)
    return df.join(reversal_groups(df, cols).select(*keys), on=keys, how="left_anti")


def drop_reversals_windowed(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Pair removal with window aggregates over the six keys (no join).

    One scan and one exchange, but the window gathers every pair group in one
    task: only for data known to have no hot key.  NULL key parts never form
    a pair, as in the equi-join form.
    """
    keys = list(cols.reversal_keys)
    w = Window.partitionBy(*keys)
    n, s = F.count(F.lit(1)).over(w), F.sum(cols.total).over(w)
    pair = (n == 2) & (s == 0) & X.all_not_null(keys)
    return df.withColumn("_pair", pair).filter(~F.col("_pair")).drop("_pair")


def reversal_members(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS, prune: bool = False) -> DataFrame:
    """(reversal keys + fare) of every member row of a reversal pair.

    Used by the fused curation plan: because a reversal group holds exactly
    two rows, listing the fare of both members lets the removal be done as a
    left-anti join on the seven de-duplication keys *after* keep-best, which
    reuses keep-best's hash partitioning (only this small side shuffles).
    Groups with a NULL key part are excluded, matching the equi-join form.
    ``prune``: only :func:`pair_candidates` are shuffled, for one more scan.
    """
    keys = list(cols.reversal_keys)
    df = pair_candidates(df, cols) if prune else df
    pairs = (df.groupBy(*keys)
               .agg(F.sum(cols.total).alias("_sum"), F.count(F.lit(1)).alias("_n"),
                    F.min(cols.fare).alias("_f1"), F.max(cols.fare).alias("_f2"))
               .filter((F.col("_sum") == 0) & (F.col("_n") == 2) & X.all_not_null(keys)))
    return (pairs.select(*keys, F.explode(F.array_distinct(F.array("_f1", "_f2"))).alias(cols.fare))
                 .filter(F.col(cols.fare).isNotNull()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1))


def keep_best(df: DataFrame, keys: Sequence[str], order_desc: str,
              tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: highest ``order_desc``; ties go to the smallest
    ``tiebreak`` tuple (default: every other column), so the result is
    deterministic.  ``row_number() = 1`` lets Catalyst insert a partial
    group limit below the shuffle."""
    keys = list(keys)
    if tiebreak is None:
        tiebreak = [x for x in df.columns if x not in keys and x != order_desc]
    w = Window.partitionBy(*keys).orderBy(
        F.col(order_desc).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in tiebreak])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def dedup_trips(df: DataFrame, cols: TripColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Keep-best on the seven trip keys by total_amount."""
    return keep_best(df, cols.dedup_keys, cols.total, cols.tiebreak)
