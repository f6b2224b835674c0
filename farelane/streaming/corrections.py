"""Monthly curation driven by a ledger of file versions.

A file stream knows files by their names: a month that is landed again under
its old names is never read again.  Here a ledger table holds name,
modification time and length of every file whose month was published.  A run
holds the listing against it (two anti joins; no file is opened) and rebuilds
the months in which a file is new, differs or is gone.  A file that changes
while a run reads it differs from what the run recorded, so the next run
takes its month again.  Contents that change with neither time nor length
cannot be seen without reading the files.

Pairs and duplicates are searched inside each file month, or, with
``pair_scope="load"``, across the months of all files, as a batch load of
everything does.  For that a state table keeps, per month, one narrow row a
pair key (rows and sum of totals) and one a duplicate key (the month's best
row).  A changed month brings its own keys only: what the state says of those
keys before and after tells which rows of other months now stay or go, and
only such months are built again besides the changed ones.  Repaired
timestamps lie in the file's year or next to it, so a key can only meet keys
of neighbouring file years, and only those partitions of the state are read.

A step publishes its months first, then writes state and ledger: a run that
is broken off repeats its step and comes to the same tables.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelane import spec
from farelane.functions import columns as X
from farelane.operators import dedup, shape
from farelane.plans.curate import complete, not_dropped, prepare, remove_pairs_and_duplicates
from farelane.session import staged
from farelane.sinks.parquet import PARTITION_COLUMNS, clear_month, gated_publish, write_partitioned
from farelane.sources.files import curated_schema, file_listing, month_glob
from farelane.sources.runmodes import Month, read_selected
from farelane.spec import DEFAULT_COLUMNS, TripColumns

VERSION = ("path", "modificationTime", "length")
LEDGER_SCHEMA = "path string, modificationTime timestamp, length bigint, file_year string, file_month string"


# -- the ledger ----------------------------------------------------------------------

def file_versions(spark: SparkSession, folder: str, vehicle: str) -> DataFrame:
    """Name, modification time, length and month of every monthly raw file."""
    files = file_listing(spark, month_glob(folder, vehicle), VERSION)
    ym = F.regexp_extract(F.substring_index("path", "/", -2), spec.FILE_MONTH_PATTERN, 1)
    return files.select(*VERSION, F.substring(ym, 1, 4).alias("file_year"), F.substring(ym, 6, 2).alias("file_month")).where("file_year <> ''")


def table_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A partitioned table, without rows where nothing was written yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def changed_months(now: DataFrame, known: DataFrame) -> list[Month]:
    """Months in which a file is new, has another version or is gone; one row
    a month reaches the driver."""
    months = [F.col(c) for c in PARTITION_COLUMNS]
    new = now.join(known, list(VERSION), "left_anti").select(*months)
    gone = known.join(now, list(VERSION), "left_anti").select(*months)
    return sorted(tuple(r) for r in new.unionByName(gone).distinct().collect())


def in_months(months: Sequence[Month]):
    """Condition on the partition columns."""
    return F.concat(*PARTITION_COLUMNS).isin([y + m for y, m in months])


# -- pairs and duplicates across months ------------------------------------------------

class KeyState:
    """Per month one row a pair key and one a duplicate key, in two tables
    that are partitioned by month."""

    def __init__(self, spark: SparkSession, home: str, cols: TripColumns):
        self.spark, self.cols = spark, cols
        self.paths = {"pairs": f"{home}/pairs", "best": f"{home}/best"}
        self.pair_keys, self.best_keys = list(cols.reversal_keys), list(cols.dedup_keys)

    def of_months(self, rows: DataFrame) -> dict[str, DataFrame]:
        """The state's rows of prepared trips: one pass each, reduced before the shuffle."""
        cols = self.cols.by_month()
        tie = self.cols.tiebreak or [c for c in rows.columns if c not in (*self.best_keys, self.cols.total, *PARTITION_COLUMNS)]
        best = [*self.best_keys, F.col(self.cols.total).alias("_total"), F.struct(*tie).alias("_tie"), *PARTITION_COLUMNS]
        # a row that no other of its month shares the pair keys with is its own pair row and best row
        alone, together = dedup.split_shared(rows, cols.reversal_keys)
        pairs = (together.groupBy(*self.pair_keys, *PARTITION_COLUMNS).agg(F.sum(self.cols.total).alias("_sum"), F.count("*").alias("_n"))
                 .hint("rebalance", *PARTITION_COLUMNS))
        leads = dedup.dedup_trips(not_dropped(together, cols), cols).select(*best).hint("rebalance", *PARTITION_COLUMNS)
        if alone is not None:
            single = alone.select(*self.pair_keys, *PARTITION_COLUMNS, F.col(self.cols.total).alias("_sum"), F.lit(1).cast("bigint").alias("_n"))
            pairs, leads = single.unionByName(pairs), not_dropped(alone, cols).select(*best).unionByName(leads)
        return {"pairs": pairs.where(X.all_not_null(self.pair_keys)), "best": leads}

    def stored(self, name: str, like: DataFrame, years: Sequence[int]) -> DataFrame:
        held = table_or_empty(self.spark, self.paths[name], like.schema).select(*like.columns)
        return held.where(F.col(PARTITION_COLUMNS[0]).isin([f"{y:04d}" for y in range(min(years) - 1, max(years) + 2)]))

    def drops(self, pairs: DataFrame, best: DataFrame) -> DataFrame:
        """Duplicate keys and months of the state's best rows that do not stay:
        members of a pair, and rows that another month betters."""
        zero = (pairs.groupBy(*self.pair_keys).agg(F.sum("_sum").alias("_s"), F.sum("_n").alias("_c"))
                     .where("_s = 0 AND _c = 2").select(*self.pair_keys, F.lit(True).alias("_pair")))
        named = best.join(zero, self.pair_keys, "left")
        # as keep-best: highest total, NULL last; then the smallest tie-break, NULL first
        first = F.struct(F.col("_total").isNull().alias("a"), (-F.col("_total")).alias("b"), F.col("_tie").alias("c"), *PARTITION_COLUMNS)
        leads = (named.where("_pair IS NULL").groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.best_keys)])
                      .agg(F.min(first).alias("_first"), F.count("*").alias("_rows")).where("_rows > 1"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.best_keys)]
        met = named.join(leads, same, "left")
        lost = F.col("_first").isNotNull() & ~(F.struct(*PARTITION_COLUMNS) == F.struct(*[F.col(f"_first.{c}") for c in PARTITION_COLUMNS]))
        return met.where(F.col("_pair").isNotNull() | lost).select(*self.best_keys, *PARTITION_COLUMNS)

    def shared(self, *states: dict[str, DataFrame]) -> Callable[[dict[str, DataFrame]], dict[str, DataFrame]]:
        """What cuts a state down to the pair keys that more than one row of
        ``states`` stands for: no other key is in a pair or a duplicate."""
        hashes = F.xxhash64(*self.pair_keys).alias("_h")
        # a key without NULL is in the pair rows, whatever the best rows say
        rows = [x for s in states for x in (s["pairs"].select(hashes, F.col("_n").alias("_rows")),
                                            s["best"].where(~X.all_not_null(self.pair_keys)).select(hashes, F.lit(1).cast("bigint").alias("_rows")))]
        many = staged(reduce(DataFrame.unionByName, rows).groupBy("_h").agg(F.sum("_rows").alias("_n")).where("_n > 1").select("_h"), "shared-keys")
        bitmaps = dedup.key_bitmaps(many)
        if bitmaps is None:
            return lambda state: state
        held = bitmaps.rows.checkpoint()  # 128 MB at most
        return lambda state: {k: x.join(F.broadcast(held), bitmaps.bucket(self.pair_keys)).where(bitmaps.hit(self.pair_keys)).select(*x.columns)
                              for k, x in state.items()}

    def decide(self, months: Sequence[Month], new: dict[str, DataFrame]) -> tuple[list[Month], DataFrame]:
        """What the changed ``months`` bring about: other months in which rows
        now stay or go, and the rows that go of these and the changed ones."""
        years, whole = [int(y) for y, _ in months], new
        old = {k: self.stored(k, new[k], years) for k in new}
        cut = self.shared(old, new)
        old, new = ({k: staged(x, f"near-{k}") for k, x in cut(s).items()} for s in (old, new))
        kept = {k: old[k].where(~in_months(months)).unionByName(new[k]) for k in new}
        # keys of the changed months, before and after
        mine = [x.where(in_months(months)).select(*self.best_keys) for x in (old["best"], new["best"])]
        pair = [x.where(in_months(months)).select(*self.pair_keys) for x in (old["pairs"], new["pairs"])]
        touched = mine[0].unionByName(mine[1]).select(*self.pair_keys).unionByName(pair[0].unionByName(pair[1])).distinct()
        touched = staged(touched, "touched")
        of = [F.col(k).alias(f"_t{i}") for i, k in enumerate(self.pair_keys)]
        met = [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(self.pair_keys)]

        def dropped(state: dict[str, DataFrame]) -> DataFrame:
            near = {k: x.join(touched.select(*of), met, "left_semi") for k, x in state.items()}
            return self.drops(near["pairs"], near["best"])

        before, after = dropped(old), staged(dropped(kept), "dropped")
        here = ~in_months(months)
        differ = before.where(here).exceptAll(after.where(here)).unionByName(after.where(here).exceptAll(before.where(here)))
        others = sorted(tuple(r) for r in differ.select(*PARTITION_COLUMNS).distinct().collect())
        if not others:
            return [], after.where(in_months(months))
        # a month that is built again needs all its drops, not those of the touched keys alone
        years = [int(y) for y, _ in [*months, *others]]
        kept = {k: self.stored(k, whole[k], years).where(~in_months(months)).unionByName(whole[k]) for k in whole}
        kept = self.shared(kept)(kept)
        return others, self.drops(kept["pairs"], kept["best"]).where(in_months([*months, *others]))

    def none(self) -> dict[str, DataFrame]:
        """No rows, in the layout of the stored tables: for months without files."""
        found = {k: self.spark.read.parquet(p) for k, p in self.paths.items()}
        return {k: x.select(*[F.col(c).cast("string") if c in PARTITION_COLUMNS else c for c in x.columns]).where("false") for k, x in found.items()}

    def write(self, months: Sequence[Month], new: dict[str, DataFrame]) -> None:
        for name, rows in new.items():
            write_partitioned(rows, self.paths[name], arranged=True)
            present = {tuple(r) for r in rows.select(*PARTITION_COLUMNS).distinct().collect()}
            for month in set(months) - present:
                clear_month(self.spark, self.paths[name], month, rows.schema)


# -- the run ------------------------------------------------------------------------------

def run_corrections(spark: SparkSession, folder: str, vehicle: str, target: str, home: str,
                    harmonise: Callable[[DataFrame], DataFrame], dims: dict[str, DataFrame], cols: TripColumns = DEFAULT_COLUMNS,
                    pair_scope: str = "month", months_per_step: int = 0, strict: bool = False) -> list[tuple[list[Month], list[Month]]]:
    """Bring ``target`` up to date with the files below ``folder``.

    ``home`` (a shared folder) keeps ledger and state.  Months are taken in
    steps of ``months_per_step`` (0: all at once); the result does not depend
    on it.  Returns, per step, the changed months and the others that were
    built again for them."""
    if pair_scope not in ("month", "load"):
        raise ValueError("pair_scope must be month or load")
    ledger = f"{home.rstrip('/')}/ledger"
    listed = file_versions(spark, folder, vehicle).checkpoint()  # what a run records is what it saw before it read
    months = changed_months(listed, table_or_empty(spark, ledger, LEDGER_SCHEMA).select(*listed.columns))
    present = {tuple(r) for r in listed.select(*PARTITION_COLUMNS).distinct().collect()}
    state = KeyState(spark, f"{home.rstrip('/')}/{pair_scope}", cols) if pair_scope == "load" else None
    scoped = cols.by_month()
    unique = spec.QUALITY_UNIQUE_KEY if state else (*spec.QUALITY_UNIQUE_KEY, *PARTITION_COLUMNS)
    done = []

    def prepared(some: Sequence[Month]) -> DataFrame:
        return prepare(harmonise(read_selected(spark, folder, vehicle, list(some))), cols)

    def publish(rows: DataFrame, drop: DataFrame | None, some: Sequence[Month]) -> None:
        if drop is None:
            kept = remove_pairs_and_duplicates(rows, scoped, "fused", arranged=True)
        else:
            keys = [*cols.dedup_keys, *PARTITION_COLUMNS]
            named = drop.select(F.xxhash64(*[F.col(k).cast(rows.schema[k].dataType) for k in keys]).alias("_h"))
            alone, together = dedup.split_shared(rows, keys, named)
            gone = drop.select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)])
            kept = (dedup.dedup_trips(not_dropped(together, scoped), scoped)
                    .join(gone, [F.col(k).eqNullSafe(F.col(f"_d{i}")) for i, k in enumerate(keys)], "left_anti")
                    .hint("rebalance", *PARTITION_COLUMNS))
            kept = kept if alone is None else not_dropped(alone, scoped).unionByName(kept)
        gated_publish(shape.to_curated(complete(kept, dims, cols)), target, strict, some, unique_key=unique, arranged=True)

    step = months_per_step or len(months) or 1
    for at in range(0, len(months), step):
        some = months[at:at + step]
        here = [m for m in some if m in present]
        others: list[Month] = []
        if state is None:
            if here:
                publish(prepared(here), None, some)
        else:
            new = {k: staged(x, f"new-{k}") for k, x in (state.of_months(prepared(here)) if here else state.none()).items()}
            others, drop = state.decide(some, new)
            built = [m for m in [*here, *others] if m in present]
            if built:
                publish(prepared(built), staged(drop, "drop"), [*some, *others])
            state.write(some, new)
        for month in set(some) - present:
            clear_month(spark, target, month, spark.createDataFrame([], curated_schema()).schema)
        record = listed.where(in_months(some))
        write_partitioned(record, ledger)
        for month in set(some) - present:
            clear_month(spark, ledger, month, record.schema)
        done.append((some, others))
    return done

