"""Quality classifier: regularised quadratic discriminant analysis.

A document becomes a few transformed statistics of its whole text.  Each class
is a normal density over them; its covariance is shrunk towards the diagonal
of the pooled one.  The score is the posterior of label 1: the difference of
the two Mahalanobis log densities, with triangular factors computed once and
cached in the model.

The fit uses every labelled row: partitions send only their sums of products.

Defined results: NULL text counts as empty; an empty text has the statistics
of a text without words and is scored like any other.  Without labelled rows
of both classes, every score is the share of label 1 (0.5 without any).  NULL
labels teach nothing; a repeated label row counts again.  Every input row gets
one result row, repeated rows too; an empty table gives none.  Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

STATISTICS = ("words", "word_length", "upper", "symbols", "digits", "marks", "variety", "top_word",
              "echo", "compressed", "bare", "lines", "long_word", "first_upper")
SHRINKAGE = 0.1
_SYMBOL = re.compile(r"[^\w\s.,;:'\"()-]")
_DIGIT = re.compile(r"\d")
_BARE = re.compile(r"(?<!\S)[\W\d_]+(?!\S)")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in STATISTICS' order."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    letters = max(1, sum(map(len, words)))
    count = Counter(words)
    upper = sum(map(str.isupper, words))
    capital = sum(map(str.isupper, [w[0] for w in words]))
    symbols = len(_SYMBOL.findall(text))
    echo = sum(map(eq, words, words[1:]))
    raw = text.encode()
    packed = len(zlib.compress(raw, 1))
    m = max(1, n)
    return [
        np.log1p(n), np.log1p(letters / m), np.sqrt(upper / m), np.sqrt(symbols / chars),
        np.sqrt(len(_DIGIT.findall(text)) / chars), np.sqrt((text.count("!") + text.count("?")) / chars),
        np.log1p(len(count)) / np.log1p(m), np.sqrt(max(count.values(), default=0) / m) * np.log1p(m) / 4,
        np.sqrt(echo / m), packed / (len(raw) + 40.0), np.sqrt(len(_BARE.findall(text)) / m),
        np.log1p(text.count("\n")) - np.log1p(n) / 2, np.log1p(max(map(len, words), default=0)), np.sqrt(capital / m)]


def _statistics(id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(x, pa.list_(pa.float64()))], names=[id_col, "x"])
    return run


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x``: the statistics of every row, as a narrow saved table."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return saved(docs.select(id_col, text_col).mapInArrow(_statistics(id_col, text_col), f"`{id_col}` {kind}, x array<double>"), "quality")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log constants of both classes."""

    share: float
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        logs = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def discriminant(n: list[float], s: list[np.ndarray], ss: list[np.ndarray], shrinkage: float = SHRINKAGE) -> Discriminant:
    """The model from each class's count, sums and sums of products."""
    total = n[0] + n[1]
    if min(n) < 2:
        return Discriminant(n[1] / total if total else 0.5, [], [], [])
    means = [s[c] / n[c] for c in (0, 1)]
    spread = [ss[c] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = np.diag(np.maximum(np.diag(sum(n[c] * spread[c] for c in (0, 1))) / total, 1e-6))
    factors, constants = [], []
    for c in (0, 1):
        chol = np.linalg.cholesky((1 - shrinkage) * spread[c] + shrinkage * pooled + 1e-9 * np.eye(len(pooled)))
        factors.append(np.linalg.inv(chol))
        constants.append(float(np.log(n[c] / total) - np.log(np.diag(chol)).sum()))
    return Discriminant(n[1] / total, means, factors, constants)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition and class: 1, x and the products of x, added up."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64)
            y = np.array(batch.column("label").to_pylist())
            for c in (0, 1):
                part = np.column_stack([np.ones((y == c).sum()), x[y == c]])
                total[c] = total.get(c, 0) + part.T @ part
    for c, t in total.items():
        yield pa.RecordBatch.from_pydict({"label": pa.array([c] * t.size, pa.int32()), "at": pa.array(range(t.size), pa.int32()),
                                          "v": pa.array(t.ravel())})


def fit(features: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Learn from ``labels`` (id, 0/1 label) joined to ``features``."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("label"))
    joined = features.join(known, id_col).select("x", "label")
    d = len(STATISTICS) + 1
    sums = joined.mapInArrow(_sums, "label int, at int, v double").groupBy("label", "at").agg(F.sum("v").alias("v"))
    got = {0: np.zeros(d * d), 1: np.zeros(d * d)}
    for r in sums.collect():  # 2 * d * d rows, whatever the input
        got[r.label][r["at"]] = r.v
    m = [got[c].reshape(d, d) for c in (0, 1)]
    return discriminant([t[0, 0] for t in m], [t[0, 1:] for t in m], [t[1:, 1:] for t in m], shrinkage)


def score(features: DataFrame, model: Discriminant, id_col: str = "doc_id") -> DataFrame:
    """``id, score`` for every row of ``features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(model.score(x), pa.float64())], names=[id_col, "score"])
    kind = features.schema[id_col].dataType.simpleString()
    return features.mapInArrow(run, f"`{id_col}` {kind}, score double")
