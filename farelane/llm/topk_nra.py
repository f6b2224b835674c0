"""Exact top-k inner products by no-random-access aggregation.

Every dimension is a list of candidates sorted by what they add to a query's
score.  The lists are read in step from their best end; a candidate's score
lies between what was read of it plus the lists' worst entries, and what was
read plus the entries reached.  Reading stops when no outsider's upper bound
reaches the k-th best lower bound (ties stay in); the scores of those left are
then resolved.  The bounds of a block of queries after one more stretch of the
lists are products of matrices; where a first stretch rules out less than half
of the candidates, the lists are read to their end at once.

Candidates are dealt to blocks of about BLOCK_ROWS rows, queries to blocks of
QUERY_ROWS.  In a first round each query block meets one candidate block; the
k-th best score found is where the query's bounds begin in the second round,
in which it meets all others: a candidate block whose best entries together
do not reach it is not read at all.  There groups of up to GROUP_BLOCKS query
blocks meet groups of candidate blocks, so a block travels once for a group,
not for every block that it meets.  A task holds one group of query blocks
with their k best so far, whose last is the bound for what follows, and one
candidate block at a time.  Blocks travel in the narrowest integers that hold
them, few in an Arrow batch.

Defined results: vectors that are NULL or hold a NULL or non-finite component
take no part, nor do NULL ids.  Components missing at the end of a shorter
vector count as 0.  Of rows that repeat an id, the one with the smallest
vector stands.  Ties go to the smaller id.  With fewer than k candidates all
are returned; an empty table gives no rows.  Scores are 64-bit integers: the
inner products must stay below 2**53.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BLOCK_ROWS, QUERY_ROWS = 4096, 256
#: Query blocks that meet one copy of a candidate block, and candidate blocks that meet one of a query block, at most.
GROUP_BLOCKS, GROUP_CANDIDATES = 128, 64
#: Blocks in one Arrow batch.
BATCH_BLOCKS = 8
#: Shares of the lists read before the whole of them.
DEPTHS = (1 / 16, 1 / 4)


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: floor(scale * component) of every usable vector."""
    v = F.col(vector_col)
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & usable)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))


def _packed(rows: DataFrame, block: Column, name: str, extra: str | None = None) -> DataFrame:
    """One row per block: ids and the matrix as bytes, in integers of
    ``width`` bytes (and a column of doubles)."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        d = max(map(len, pdf["x"]), default=0)
        m = np.zeros((len(pdf), d), np.int64)
        for i, x in enumerate(pdf["x"]):
            m[i, :len(x)] = x
        low, high = int(m.min(initial=0)), int(m.max(initial=0))
        kind = next(np.dtype(t) for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        out = {name: [pdf[name].iloc[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "rows": [m.astype(kind).tobytes()], "width": [kind.itemsize]}
        if extra:
            out[extra] = [pdf[extra].to_numpy(np.float64).tobytes()]
        return pd.DataFrame(out)
    return rows.withColumn(name, block).groupBy(name).applyInPandas(
        pack, f"{name} long, ids binary, rows binary, width int" + (f", {extra} binary" if extra else ""))


class SortedLists:
    """The candidates of one block, sorted per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows, self.x = ids, rows, rows.astype(np.float64)
        order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, order, axis=0)  # ascending
        self.rank = np.empty(rows.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(rows), dtype=np.int32)[:, None], axis=0)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates other than ``own``."""
        return self.best(query[None], np.array([own]), k, np.array([-np.inf]))[0]

    def read(self, pos: np.ndarray, neg: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries x candidates) after ``depth``
        entries of each list: ``pos`` reads from the high end, ``neg`` from
        the low end."""
        n = len(self.ids)
        first, last, high, low = self.values[0], self.values[-1], self.values[n - depth], self.values[depth - 1]
        up, down = self.rank >= n - depth, self.rank < depth
        lows = (pos @ first + neg @ last)[:, None] + pos @ np.where(up, self.x - first, 0).T + neg @ np.where(down, self.x - last, 0).T
        highs = (pos @ high + neg @ low)[:, None] + pos @ np.where(up, self.x - high, 0).T + neg @ np.where(down, self.x - low, 0).T
        return lows, highs

    def best(self, queries: np.ndarray, own: np.ndarray, k: int, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query ids and scores of the k best candidates other than its
        own whose scores reach its bound."""
        n = len(self.ids)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
        if n == 0 or queries.shape[1] == 0:
            self_free = [np.flatnonzero(self.ids != o)[:k] for o in own]
            return [(self.ids[f], np.zeros(len(f), np.int64)) if b <= 0 else o for f, b, o in zip(self_free, bounds, out)]
        q = queries.astype(np.float64)
        pos, neg, bounds = np.maximum(q, 0), np.minimum(q, 0), bounds.copy()

        def settle(i: int, left: np.ndarray, scores: np.ndarray) -> None:
            order = np.lexsort((self.ids[left], -scores))[:k]
            order = order[scores[order] >= bounds[i]]
            out[i] = self.ids[left][order], scores[order].astype(np.int64)

        # what all best entries together reach
        left = np.flatnonzero(pos @ self.values[-1] + neg @ self.values[0] >= bounds)
        for share in DEPTHS:
            depth = int(n * share)
            if depth < k or not len(left):
                continue
            lows, highs = self.read(pos[left], neg[left], depth)
            mine = self.ids[None, :] == own[left][:, None]
            lows[mine] = highs[mine] = -np.inf
            if n > k:
                bounds[left] = np.maximum(bounds[left], np.partition(lows, n - k, axis=1)[:, n - k])
            may = highs >= np.maximum(bounds[left], np.finfo(float).min)[:, None]
            counts = may.sum(axis=1)
            done = counts <= max(4 * k, n // 64)
            for i, row in zip(left[done].tolist(), may[done]):
                found = np.flatnonzero(row)
                settle(i, found, self.rows[found] @ queries[i])
            left = left[~done]
            if len(left) and np.median(counts[~done]) > n // 2:
                break
        if len(left):  # the lists are read to their end: bounds and scores are one
            scores = q[left] @ self.x.T
            scores[self.ids[None, :] == own[left][:, None]] = -np.inf
            floor = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(left), -np.inf)
            for i, row, low in zip(left.tolist(), scores, np.maximum(floor, bounds[left])):
                found = np.flatnonzero((row >= low) & (row > -np.inf))
                settle(i, found, row[found])
        return out


class _Queries:
    """A block of queries, and the k best candidates met so far."""

    def __init__(self, n: int, ids: np.ndarray, rows: np.ndarray, bounds: np.ndarray):
        self.n, self.ids, self.rows, self.bounds = n, ids, rows, bounds.copy()
        none = np.empty(0, np.int64)
        self.held = [(none, none)] * len(ids)

    def meet(self, lists: SortedLists, k: int) -> None:
        d = lists.rows.shape[1]
        found = lists.best(np.pad(self.rows, ((0, 0), (0, d - self.rows.shape[1]))), self.ids, k, self.bounds)
        for i, (ids, scores) in enumerate(found):
            if not len(ids):
                continue
            if len(self.held[i][0]):
                ids, scores = (np.concatenate(v) for v in zip(self.held[i], (ids, scores)))
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
            self.held[i] = ids, scores
            if len(ids) == k:
                self.bounds[i] = max(self.bounds[i], scores[-1])  # ties of the last one may have smaller ids

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "query_id": np.repeat(self.ids, [len(f[0]) for f in self.held]),
            "vec_id": np.concatenate([f[0] for f in self.held]), "score": np.concatenate([f[1] for f in self.held])})


def _meet(k: int, own: int | None):
    """Rows come by group, ``n`` and queries before candidates.  ``own``: how
    many candidate blocks there are, where query blocks have met theirs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if at != (r["cg"], r["g"]):
                    yield from (q.result() for q in queries)
                    at, queries = (r["cg"], r["g"]), []
                ids = np.frombuffer(r["ids"], np.int64)
                rows = np.frombuffer(r["rows"], f"i{r['width']}").reshape(len(ids), -1).astype(np.int64)
                if r["bound"] is not None:
                    queries.append(_Queries(r["n"], ids, rows, np.frombuffer(r["bound"], np.float64)))
                    continue
                lists: dict[int, SortedLists] = {}
                for q in queries:
                    if own is not None and q.n % own == r["n"]:
                        continue
                    d = max(rows.shape[1], q.rows.shape[1])
                    if d not in lists:
                        lists = {d: SortedLists(ids, np.pad(rows, ((0, 0), (0, d - rows.shape[1]))))}
                    q.meet(lists[d], k)
        yield from (q.result() for q in queries)
    return run


def _met(queries: DataFrame, candidates: DataFrame, k: int, label: str, own: int | None = None) -> DataFrame:
    """``query_id, vec_id, score`` of the k best that each query block finds
    in every group (``cg``, ``g``) it shares with candidate blocks."""
    spark, name = queries.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    columns = ["cg", "g", "n", "ids", "rows", "width"]
    rows = queries.select(*columns, "bound").unionByName(candidates.select(*columns, F.lit(None).cast("binary").alias("bound")))
    # few bytes, much work: a fixed number of tasks, which are not merged by size
    tasks, before = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BLOCKS))
    try:
        return saved(rows.repartition(tasks, "cg", "g").sortWithinPartitions("cg", "g", F.col("bound").isNull(), "n")
                     .mapInArrow(_meet(k, own), "query_id long, vec_id long, score long"), label)
    finally:
        spark.conf.set(name, before)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` (a
    condition on ``vec_id``) holds, against all other rows."""
    spark = vectors.sparkSession
    usable = saved(integer_vectors(vectors, scale, id_col, vector_col), "vectors")
    n, asked = usable.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = -(-n // BLOCK_ROWS) or 1, -(-asked // QUERY_ROWS) or 1
    deal = lambda to: F.pmod(F.xxhash64("vec_id"), F.lit(to)).cast("long")
    packed = saved(_packed(usable, deal(blocks), "n"), "blocks")
    asking = usable.where(is_query)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    none = F.lit(0).cast("long").alias("g")

    asked_first = _packed(asking.withColumn("bound", F.lit(float("-inf"))), deal(query_blocks), "n", "bound")
    first = _met(asked_first.withColumn("cg", F.pmod("n", F.lit(blocks))).withColumn("g", none),
                 packed.where(F.col("n") < query_blocks).withColumn("cg", F.col("n")).withColumn("g", none), k, "first")
    if blocks == 1:
        met = first
    else:
        reached = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound"))
        again = saved(_packed(asking.join(reached, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))), deal(query_blocks), "n", "bound"), "queries")
        # some groups a task, so that tasks are alike
        groups, tasks = -(-query_blocks // GROUP_BLOCKS), int(spark.conf.get("spark.sql.shuffle.partitions"))
        candidate_groups = max(-(-blocks // GROUP_CANDIDATES), min(blocks, -(-4 * tasks // groups)))
        every = lambda to, name: F.explode(F.sequence(F.lit(0), F.lit(to - 1)).cast("array<bigint>")).alias(name)
        met = first.unionByName(_met(again.select("*", F.pmod("n", F.lit(groups)).alias("g"), every(candidate_groups, "cg")),
                                     packed.select("*", F.pmod("n", F.lit(candidate_groups)).alias("cg"), every(groups, "g")), k, "others", own=blocks))
    return (met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
