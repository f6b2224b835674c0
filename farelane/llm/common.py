"""Helpers shared by the operators: table access, scratch tables, connected
components and a cache that lives as long as one Python worker."""

from __future__ import annotations

import sys
import types

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Removes the files of a query's own shuffles as soon as the query has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: cuts
    the lineage, survives lost executors and fixes the rows of
    non-deterministic plans."""
    return Run(df.sparkSession).saved(df, label)


class Run:
    """Saved tables of one operator call.  ``drop`` removes those whose last
    reader has been written, ``result`` saves the result and removes all
    others, so a call leaves its result alone behind."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def saved(self, df: DataFrame, label: str) -> DataFrame:
        path, before = scratch_path(self.spark, label), self.spark.conf.get(CLEAN_UP, "false")
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *frames: DataFrame) -> None:
        gone = [path for f, path in self.held if any(f is x for x in frames)]
        self.held = [x for x in self.held if x[1] not in gone]
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in gone:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)

    def result(self, df: DataFrame) -> DataFrame:
        before = [f for f, _ in self.held]
        out = self.saved(df, "result")
        self.drop(*before)
        return out


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows: a batch of long texts must fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], text_col: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, so that what a
    task keeps per batch is bounded whatever the session's batch size; a
    longer text is alone."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right"))
            to = max(at + 1, to)
            yield batch.slice(at, to - at)
            at = to


def worker_cache(name: str) -> dict:
    """A dict kept by the Python worker between its tasks.  Callers bound it.
    A worker goes on from one operator to the next: the tables of the others
    are let go, so that a worker holds one operator's at a time."""
    home = sys.modules.setdefault("farelane_worker_cache", types.ModuleType("farelane_worker_cache"))
    for other, held in home.__dict__.items():
        if isinstance(held, dict) and other not in (name, "__builtins__") and not other.startswith("__"):
            held.clear()
    return home.__dict__.setdefault(name, {})


def _stars(edges: DataFrame) -> bool:
    """Whether every ``hi`` has one ``lo`` and no ``lo`` is a ``hi``."""
    ends = edges.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("lo").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", run: Run | None = None) -> DataFrame:
    """Connected components of undirected ``edges``: ``(id, component)`` with
    the smallest id of each component, for every id that has an edge.

    Alternating large-star / small-star rounds.  A round only takes minima per
    node (partial aggregates) and joins them back, so a hub is never gathered
    in one task; the edge count never grows.  Ends when every node points to
    one other that points nowhere; no round limit.
    """
    run = run or Run(edges.sparkSession)
    cur = run.saved(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                    .where("lo <> hi").distinct(), "cc")
    while not _stars(cur):
        both = cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo <> hi"))
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        last, cur = cur, run.saved(moved.unionAll(root.select("hi", F.col("m").alias("lo"))).where("lo <> hi").distinct(), "cc")
        run.drop(last)
    return cur.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(
        cur.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


#: Rows of a cell from which it is hot.
HOT_ROWS = 100
#: Rounds at most in which every mixed cell holds its members against one more of them; pairs a member that need no round.
LEAD_ROUNDS, PAIRS_A_MEMBER = 4, 10
#: Pairs a member with the smallest ids of its cells up to which all are verified at once.
STARS_A_MEMBER = 4
#: Rows of a part of a crowded cell: its parts are held against each other two by two.
PART_ROWS = 2000


def shared_cells(cells: DataFrame, run: Run, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Of ``cells`` (id, family, spare, cell), those that hold more than one
    id: cell, id, ``lead`` (the cell's smallest id) and ``counts``.

    Cells of one ``family`` of an id are its keys for one kind of partner: a
    linked pair agrees in all of them but the number that their differences
    can touch, and has ``spare`` cells beyond that number.  An id with no more
    hot cells than spare ones so agrees with every partner in a cell that is
    not hot, and does not count in its hot cells; ids that do not count lose
    no link.  Cells that hold the same ids bring the same pairs together: one
    of them stays, so rows grow with the groups of ids, not with the cells that
    a group has in common.  Counts are partial aggregates and the join can be
    split, so a hot cell is never gathered."""
    # most cells have one row: only the others go on to the wider steps
    often = run.saved(cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
                      .select("cell", (F.col("n") > hot_rows).alias("hot")), "often")
    rows = run.saved(cells.join(often, "cell").distinct(), "shared")
    member = ["id", "family", "hot"]
    sums = (rows.groupBy("cell").agg(F.min("id").alias("lead"), F.max("id").alias("last"), F.count("*").alias("n"),
                                     F.bit_xor(F.xxhash64(*member)).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), *member)).alias("y"))
            .where("lead < last"))
    kept = sums.groupBy("n", "x", "y").agg(F.min("cell").alias("cell"), F.min("lead").alias("lead")).select("cell", "lead")
    heat = (rows.where("hot").join(sums.select("cell"), "cell").groupBy("id", "family")
            .agg(F.count("*").alias("hot_cells"), F.min("spare").alias("room"))
            .where("hot_cells <= room").select("id", "family", F.lit(True).alias("free")))
    out = run.saved(rows.join(kept, "cell").join(heat, ["id", "family"], "left")
                    .select("cell", "id", "lead", (~(F.col("hot") & F.coalesce("free", F.lit(False)))).alias("counts")), "shared")
    run.drop(often, rows)
    return out


def merged(comp: DataFrame | None, links: DataFrame, run: Run) -> DataFrame:
    """Components after more links: only the graph of components is walked."""
    if comp is None:
        return run.saved(components(links, run=run), "component")
    ends = [comp.select(F.col("id").alias(s), F.col("component").alias(f"c{s}")) for s in "ab"]
    edges = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    more = components(edges, run=run)
    moved = (comp.join(more.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
             .select("id", F.coalesce("to", "component").alias("component")))
    out = run.saved(moved.unionByName(more.join(comp.select("id"), "id", "left_anti")), "component")
    run.drop(comp)
    return out


def crowded_pairs(rows: DataFrame, agreeing: Callable[[tuple, pa.Table], pa.Table], part_rows: int = PART_ROWS) -> DataFrame:
    """Pairs ``(a, b)`` that ``agreeing`` finds among ``rows`` (cell, id, n,
    ...) of one cell.  The ``n`` rows of a cell are dealt to parts, and every
    two parts, and each with itself, are a group of their own: a task holds
    two parts at most, every pair is in one group, and what does not agree is
    never written.  ``second`` tells the rows of the second part."""
    parts = F.ceil(F.col("n") / part_rows)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    met = dealt.select("*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).alias("second"))
    # few bytes, much work: a fixed number of tasks, which are not merged by size
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.drop("n", "part", "other").repartition(tasks, "cell", "i", "j").groupBy("cell", "i", "j").applyInArrow(agreeing, "a long, b long")


def cell_components(shared: DataFrame, facts: DataFrame, may: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
                    verified: Callable[[DataFrame, str], DataFrame], run: Run, lead_rounds: int = LEAD_ROUNDS,
                    contents: DataFrame | None = None, agreeing: Callable[[tuple, pa.Table], pa.Table] | None = None,
                    crowd: int = HOT_ROWS) -> DataFrame:
    """Components of all verified pairs that share a cell: ``(id, component)``
    for every id that has a link.

    1. Each member is held against the smallest ids of its cells: all at once
       when these are few, else first one pair a member, which joins tight
       groups, then those still apart.
    2. In ``lead_rounds`` rounds at most every cell that holds several
       components takes another member, and holds those of other components
       against it.  Each of these rounds and the first are linear in the
       members.  They end early when the cells have at most PAIRS_A_MEMBER
       pairs a member left, or when a round leaves more than half of the pairs.
    3. Members that count (see ``shared_cells``) of cells that still hold
       several components are held against those of other components.

    Links inside one component cannot change it, so none that matters is
    lost.  Step 3 makes at most HOT_ROWS / 2 pairs a member in cells that are
    not hot; in hot ones it makes pairs only of ids most of whose cells are
    hot, and whose components the rounds have not joined.

    ``may(a, b)`` says by ``facts`` (id, ...) which pairs can link; a and b
    give the columns of either side.  ``verified`` decides.  With ``contents``
    (id, ...), step 3 takes these along in cells of more than ``crowd`` rows,
    where pairs are many more than rows, and ``agreeing`` names those that
    ``verified`` is given (see ``crowded_pairs``; ``c`` is the component).
    """
    names = [c for c in facts.columns if c != "id"]
    side = {s: facts.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names]) for s in "ab"}
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))

    def possible(pairs: DataFrame) -> DataFrame:
        return pairs.join(side["a"], "a").join(side["b"], "b").where(may(a, b)).select("a", "b")

    stars = run.saved(possible(shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()), "stars")
    pairs, members = stars.groupBy("b").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    few = pairs <= STARS_A_MEMBER * members
    links = verified(stars if few else stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "links")
    comp = merged(None, links, run)
    run.drop(links)

    def joined(more: DataFrame, comp: DataFrame) -> DataFrame:
        out = comp if more.isEmpty() else merged(comp, more, run)
        run.drop(more)
        return out

    if not few:
        ends = [comp.select(F.col("id").alias(s), F.col("component").alias(f"c{s}")) for s in "ab"]
        apart = (stars.join(ends[0], "a", "left").join(ends[1], "b", "left")
                 .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
        comp = joined(verified(apart, "links"), comp)
    run.drop(stars)
    held = shared.where("counts").select("cell", "id")
    previous, before = None, None
    for turn in range(lead_rounds + 1):
        named = held.join(comp, "id", "left").select("cell", "id", F.coalesce("component", "id").alias("c"))
        mixed = named.groupBy("cell").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("n"),
                                         F.min_by(F.struct("id", "c"), F.xxhash64("id", F.lit(turn))).alias("lead"))
        held = run.saved(named.join(mixed.where("x <> y").select("cell", "lead", "n"), "cell"), "mixed")
        if previous is not None:
            run.drop(previous)
        previous = held
        members, left = held.groupBy("cell").agg(F.count("*").alias("m")).agg(F.sum("m"), F.sum(F.col("m") * (F.col("m") - 1) / 2)).first()
        if not members:
            break
        last = turn == lead_rounds or left <= PAIRS_A_MEMBER * members or (before is not None and 2 * left > before)
        before = left
        if not last:
            pairs = possible(held.where("c <> lead.c").select(F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b")).distinct())
        else:
            few = held.where(F.col("n") <= crowd) if agreeing else held
            x = few.select("cell", F.col("id").alias("a"), F.col("c").alias("ca")).join(side["a"], "a")
            y = few.select("cell", F.col("id").alias("b"), F.col("c").alias("cb")).join(side["b"], "b")
            pairs = x.join(y, "cell").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & may(a, b)).select("a", "b")
            if agreeing:
                many = held.where(F.col("n") > crowd).select("cell", "id", "c", "n").join(facts, "id").join(contents, "id")
                pairs = pairs.unionAll(crowded_pairs(many, agreeing))
            pairs = pairs.distinct()
        pairs = run.saved(pairs, "pairs")  # the files that made them go before contents are joined
        comp = joined(verified(pairs, "links"), comp)
        run.drop(pairs)
        if last:
            break
        held = held.select("cell", "id")
    run.drop(previous)
    return comp
