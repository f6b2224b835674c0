"""Toxicity: a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and the 4- and 5-letter starts
of its words, hashed to buckets.  Besides a weight per bucket the machine
learns a short vector per bucket; the inner product of two vectors weighs the
pair of terms, so an insult beside a group's name can count for more than
either alone.

Learning takes a bounded sample of labelled rows, SAMPLE_ROWS at most (those
with the smallest hash of their id), small enough to broadcast.  Of these, the
BUCKETS_KEPT buckets that differ most between the classes (chi-square, at
least MIN_CHI2) enter the machine, if their odds differ by a factor of
MIN_ODDS: a smaller one only says how long the texts are.  Scoring covers every row's whole text.

Defined results: NULL text counts as empty; a text without terms in the
machine has the score of its bias.  Without labelled rows of both classes,
every score is the share of label 1 (0 without any).  NULL labels teach
nothing; of repeated labels of an id the largest counts.  One result row per
input row, repeated rows too; an empty table gives none.  Columns other than
the id and the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, worker_cache

SAMPLE_ROWS = 30_000
BUCKETS = 1 << 20
BUCKETS_KEPT = 4096
MIN_CHI2, MIN_ODDS = 25.0, 3.0
FACTORS = 4
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.03, 1e-4
CACHE_WORDS = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def buckets_of(token: str) -> list[int]:
    """Buckets of the terms in one white-space separated token."""
    import xxhash
    out = []
    for word in _WORD.findall(token.lower()):
        terms = {word} | {f"{word[:k]}*" for k in (4, 5) if len(word) >= k}
        out += [xxhash.xxh32_intdigest(t) % BUCKETS for t in terms]
    return out


def _terms(text: str | None, table: dict) -> np.ndarray:
    tokens = set((text or "").split())
    if len(table) > CACHE_WORDS:
        table.clear()
    found: set[int] = set()
    for t in tokens:
        ids = table.get(t)
        if ids is None:
            ids = table[t] = buckets_of(t)
        found.update(ids)
    return np.array(sorted(found), dtype=np.int32)


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = worker_cache("toxicity_terms")
    for batch in batches:
        terms = [_terms(t, table) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(terms, pa.list_(pa.int32()))], names=["label", "terms"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a bucket, added up per partition."""
    total = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        terms, offsets = batch.column("terms").values.to_numpy(), batch.column("terms").offsets.to_numpy()
        y = np.repeat(batch.column("label").to_numpy(), np.diff(offsets))
        terms = terms[offsets[0]:offsets[-1]]
        for c in (0, 1):
            total[c] += np.bincount(terms[y == c], minlength=BUCKETS)
    at = np.flatnonzero(total.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["bucket", "n0", "n1"])


@dataclass
class Machine:
    """Bias, weights and factors over the kept buckets; ``at`` maps a bucket
    to its row (-1: not kept)."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Logits of documents whose rows lie one after another in ``flat``."""
        n = np.diff(starts)
        out = np.full(len(n), self.bias)
        some = n > 0
        if some.any():
            at = starts[:-1][some]
            v = self.factors[flat]
            s = np.add.reduceat(v, at, axis=0)
            q = np.add.reduceat(v * v, at, axis=0)
            out[some] += np.add.reduceat(self.weights[flat], at) + 0.5 * (s * s - q).sum(axis=1)
        return out

    def scores(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(flat, starts), -500, 500)))


def train(rows: list[np.ndarray], y: np.ndarray, buckets: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the logistic loss with weight decay.  ``rows``: each document's
    rows in ``buckets``."""
    k = len(buckets)
    share = float(y.mean()) if len(y) else 0.0
    rng = np.random.default_rng(seed)
    m = Machine(float(np.log((share + 1e-6) / (1 - share + 1e-6))), buckets, np.zeros(k), rng.normal(0, 0.02, (k, FACTORS)))
    if not 0 < share < 1 or k == 0:
        return m
    theta = np.concatenate([m.weights[:, None], m.factors], axis=1)
    first, second, bias = np.zeros_like(theta), np.zeros_like(theta), np.zeros(3)
    bias[0], step = m.bias, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            starts = np.concatenate([[0], np.cumsum([len(rows[i]) for i in pick])])
            flat = np.concatenate([rows[i] for i in pick]) if starts[-1] else np.empty(0, np.int64)
            m.bias, m.weights, m.factors = bias[0], theta[:, 0], theta[:, 1:]
            err = (m.scores(flat, starts) - y[pick]) / len(pick)
            owner = np.repeat(np.arange(len(pick)), np.diff(starts))
            v = m.factors[flat]
            sums = np.zeros((len(pick), FACTORS))
            for f in range(FACTORS):
                sums[:, f] = np.bincount(owner, v[:, f], len(pick))
            g = np.zeros_like(theta)
            g[:, 0] = np.bincount(flat, err[owner], k)
            pull = err[owner][:, None] * (sums[owner] - v)
            for f in range(FACTORS):
                g[:, f + 1] = np.bincount(flat, pull[:, f], k)
            g += DECAY * theta
            step += 1
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            fix1, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
            theta = theta - RATE * (first / fix1) / (np.sqrt(second / fix2) + 1e-8)
            e = err.sum()
            bias[1], bias[2] = 0.9 * bias[1] + 0.1 * e, 0.999 * bias[2] + 0.001 * e * e
            bias[0] -= RATE * (bias[1] / fix1) / (np.sqrt(bias[2] / fix2) + 1e-8)
    m.bias, m.weights, m.factors = float(bias[0]), theta[:, 0].copy(), theta[:, 1:].copy()
    return m


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Learn from ``labels`` (id, 0/1 label) of ``docs``."""
    small_batches(docs.sparkSession)
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key"))
             .agg(F.max(F.col(label_col).cast("int")).alias("label"))
             .orderBy(F.xxhash64("key"), "key").limit(sample_rows))
    # at most sample_rows rows of two numbers: a proven size to broadcast
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(known), "key")
    terms = saved(rows.select("label", "text").mapInArrow(_sample_terms, "label int, terms array<int>"), "toxicity")
    n = {r.label: r["count"] for r in terms.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return train([], np.full(1, 1.0 if n1 else 0.0), np.empty(0, np.int64))
    a, b, total = F.col("n1"), F.col("n0"), float(n0 + n1)
    chi2 = total * F.pow(a * F.lit(float(n0)) - b * F.lit(float(n1)), 2) / (
        F.lit(float(n0)) * F.lit(float(n1)) * (a + b) * F.greatest(F.lit(total) - a - b, F.lit(0.5)))
    odds = F.abs(F.log((a + 0.5) / (F.lit(float(n1)) - a + 0.5)) - F.log((b + 0.5) / (F.lit(float(n0)) - b + 0.5)))
    best = (terms.mapInArrow(_counts, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .withColumn("chi2", chi2).where((F.col("chi2") >= MIN_CHI2) & (odds >= float(np.log(MIN_ODDS)))).orderBy(F.desc("chi2"), "bucket").limit(BUCKETS_KEPT).select("bucket"))
    buckets = np.array(sorted(r.bucket for r in best.collect()), dtype=np.int64)
    sample = terms.select("label", F.array_intersect("terms", F.lit([int(b) for b in buckets]).cast("array<int>")).alias("terms")
                          if len(buckets) else F.array().cast("array<int>").alias("terms")).toPandas()
    sample["key"] = [x.tobytes() for x in map(np.asarray, sample["terms"])]
    sample = sample.sort_values(["label", "key"])  # the order of collected rows must not matter
    found = [np.searchsorted(buckets, np.sort(np.asarray(x, dtype=np.int64))) for x in sample["terms"]]
    return train(found, sample["label"].to_numpy(np.float64), buckets)


def _scorer(machine: Machine):
    """A function from texts to scores, with a table of the tokens it met."""
    kept = {int(b): i for i, b in enumerate(machine.buckets)}
    table: dict[str, list[int]] = {}  # rows of the machine, of every token seen

    def scores(texts: list[str | None]) -> np.ndarray:
        rows = []
        if len(table) > CACHE_WORDS:
            table.clear()
        for text in texts:
            found: set[int] = set()
            for t in set((text or "").split()):
                ids = table.get(t)
                if ids is None:
                    ids = table[t] = [kept[b] for b in buckets_of(t) if b in kept]
                if ids:
                    found.update(ids)
            rows.append(sorted(found))
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        return machine.scores(np.array([i for r in rows for i in r], dtype=np.int64), starts)
    return scores


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(machine)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(scores(batch.column(text_col).to_pylist()), pa.float64())],
                                             names=[id_col, "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_below(docs: DataFrame, machine: Machine, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns; no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(machine)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(text_col).to_pylist()) < threshold))
    return docs.mapInArrow(run, docs.schema)
