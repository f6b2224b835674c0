"""Vector code compression: product codes by k-means with adaptive bounds.

Components become integers floor(scale * x); vectors are cut into equal
consecutive parts, each with a codebook that starts as that part of the
vectors with the smallest ids.  Every round assigns all parts to their nearest
entry (squared Euclidean distance, ties to the lower index) and moves the
entries to the floor of their parts' means; unused entries stay.

Bounds after Drake and Hamerly: the first pass computes all distances and
persists, per part of a vector, its b closest entries with a lower bound of
each distance, in order, and one outer bound below the distances of all
others.  When entries move, a bound falls by its entry's movement, the outer
one by the largest movement.  In a later pass

* a part whose assigned entry is nearer than every bound keeps it;
* else the distances to the b entries are computed, as integers, and the
  nearest is right if it lies below the outer bound;
* else all distances are, and the list is made anew.

Bounds are rounded down and movements up, and a bound that is not strictly
larger decides nothing, so the codes are those of the plain computation.
``b`` follows the places in the list that parts really needed: each pass
counts them, and lists shrink to what SURE of the parts need.

The vectors stay in Spark: each pass reads the state of the one before and
writes its own.  The driver holds the codebooks, the sums per entry and the
counts of list places, all of fixed size.

Defined results: vectors that are NULL or hold a NULL or non-finite component
are dropped.  Components missing at the end of a shorter vector, or in the
last part, count as 0.  Rows that repeat an id are rows of their own; the
first entries follow (id, vector), NULL ids last.  With fewer vectors than
entries the codebooks are smaller.  Magnitudes of ``scale * x`` from 2**26 on
are refused.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Share of parts whose needed places the lists hold from the next pass on.
SURE = 0.99
LARGEST = 1 << 26
CHUNK = 1024
STATE = "vec_id {kind}, label {label}, x binary, code binary, near binary, bounds binary, outer_bound binary, places binary"


def integer_rows(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str | None = "label") -> DataFrame:
    """``vec_id, label, x``: floor(scale * component) of every usable vector."""
    v = F.col(vector_col)
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    label = F.col(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    return vectors.where(v.isNotNull() & usable).select(
        F.col(id_col).alias("vec_id"), label.alias("label"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def cut(rows: list[list[int]], parts: int, width: int) -> np.ndarray:
    """rows x parts x width, filled up with 0."""
    out = np.zeros((len(rows), parts * width), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out.reshape(len(rows), parts, width)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row to its own entries (rows x k x width) or
    to common ones (k x width)."""
    return ((x[:, None, :] - entries) ** 2).sum(axis=2)


def below(distance: np.ndarray) -> np.ndarray:
    """A 32-bit number that is surely below the square root."""
    return np.nextafter((np.sqrt(distance) * (1 - 1e-6)).astype(np.float32), np.float32(-1))


def nearest(d: np.ndarray, names: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` nearest of each row by (distance, name): names, distances."""
    order = np.lexsort((names, d), axis=1)[:, :keep] if d.shape[1] > 1 else np.zeros((len(d), 1), np.int64)
    return np.take_along_axis(names, order, 1), np.take_along_axis(d, order, 1)


class Lists:
    """Per row the ``b`` closest entries of one part, lower bounds of their
    distances in order, and the outer bound."""

    def __init__(self, near: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
        self.near, self.bounds, self.outer = near, bounds, outer

    @classmethod
    def of_all(cls, x: np.ndarray, entries: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
        """Lists from all distances, and the nearest entry's distance."""
        d = squared(x, entries)
        near, dist = nearest(d, np.broadcast_to(np.arange(len(entries)), d.shape), b + 1)
        outer = below(dist[:, b]) if len(entries) > b else np.full(len(x), np.inf, np.float32)
        return cls(near[:, :b], below(dist[:, :b]), outer), dist[:, 0]

    def shrink(self, b: int) -> None:
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.bounds[:, b:].min(axis=1))
            self.near, self.bounds = self.near[:, :b], self.bounds[:, :b]

    def reassign(self, x: np.ndarray, code: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entries after the entries moved, their squared distances,
        and how many places of the list were needed (b + 1: all entries)."""
        b = self.near.shape[1]
        self.bounds = np.nextafter(self.bounds - moved[self.near], np.float32(-np.inf))
        self.outer = np.nextafter(self.outer - moved.max(initial=0), np.float32(-np.inf))
        code = code.copy()
        dist = squared(x, entries[code][:, None, :])[:, 0]
        reach = np.sqrt(dist) * (1 + 1e-9)
        rivals = (self.bounds <= reach[:, None]) & (self.near != code[:, None])
        places = np.where(rivals.any(axis=1), b - np.argmax(rivals[:, ::-1], axis=1), 1)
        unsure = np.flatnonzero(rivals.any(axis=1) | (self.outer <= reach))
        if len(unsure):
            names, d = nearest(squared(x[unsure], entries[self.near[unsure]]), self.near[unsure], b)
            listed = np.sqrt(d[:, 0]) * (1 + 1e-9) < self.outer[unsure]
            self.near[unsure], self.bounds[unsure] = names, below(d)
            code[unsure], dist[unsure] = names[:, 0], d[:, 0]
            rest = unsure[~listed]
            if len(rest):
                anew, dist[rest] = Lists.of_all(x[rest], entries, b)
                self.near[rest], self.bounds[rest], self.outer[rest] = anew.near, anew.bounds, anew.outer
                code[rest] = anew.near[:, 0]
                places[rest] = b + 1
        return code, dist, places


def _first_pass(books: np.ndarray, b: int):
    """Whole distances: codes, lists and bounds."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x = cut(batch.column("x").to_pylist(), parts, width)
                lists = [Lists.of_all(x[:, p], books[p], b)[0] for p in range(parts)]
                yield _state(batch, x, np.stack([s.near[:, 0] for s in lists], 1), lists, np.zeros((len(x), parts), np.uint8))
    return run


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _state(batch: pa.RecordBatch, x: np.ndarray, codes: np.ndarray, lists: list[Lists], places: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), _binary(x.astype(np.int32)), _binary(codes.astype(np.uint8)),
         _binary(np.stack([s.near for s in lists], 1).astype(np.uint8)), _binary(np.stack([s.bounds for s in lists], 1).astype(np.float32)),
         _binary(np.stack([s.outer for s in lists], 1).astype(np.float32)), _binary(places.astype(np.uint8))],
        names=["vec_id", "label", "x", "code", "near", "bounds", "outer_bound", "places"])


def _matrix(column: pa.Array, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _next_pass(books: np.ndarray, moved: np.ndarray, b_held: int, b: int, last: bool):
    """Codes under moved entries; with ``last`` codes and errors alone."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x = _matrix(batch.column("x"), np.int32, parts, width).astype(np.int64)
                codes = _matrix(batch.column("code"), np.uint8, parts).astype(np.int64)
                near = _matrix(batch.column("near"), np.uint8, parts, b_held).astype(np.int64)
                bounds = _matrix(batch.column("bounds"), np.float32, parts, b_held)
                outer = _matrix(batch.column("outer_bound"), np.float32, parts)
                lists, found, error, places = [], [], np.zeros(len(x), np.int64), []
                for p in range(parts):
                    s = Lists(near[:, p], bounds[:, p], outer[:, p])
                    s.shrink(b)
                    code, dist, needed = s.reassign(x[:, p], codes[:, p], books[p], moved[p])
                    lists.append(s)
                    found.append(code)
                    places.append(needed)
                    error += dist
                codes, places = np.stack(found, 1), np.stack(places, 1)
                if last:
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(codes.astype(np.uint8)), pa.array(error)],
                                                     names=["vec_id", "label", "code", "error"])
                else:
                    yield _state(batch, x, codes, lists, places)
    return run


def _sums(parts: int, entries: int, width: int):
    """Per task and used entry: parts and their sums; per number of list
    places (entry -1): how many parts needed them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        needed = np.zeros(256, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x, codes = _matrix(batch.column("x"), np.int32, parts, width).astype(np.int64), _matrix(batch.column("code"), np.uint8, parts)
                needed += np.bincount(_matrix(batch.column("places"), np.uint8, parts).ravel(), minlength=256)
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=entries)
                    np.add.at(total[p], codes[:, p], x[:, p])
        used = [(p, e, int(count[p, e]), total[p, e].tolist()) for p, e in zip(*map(np.ndarray.tolist, np.nonzero(count)))]
        used += [(int(k), -1, int(needed[k]), [0] * width) for k in np.flatnonzero(needed)]
        columns = list(zip(*used)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))],
                                         names=["part", "entry", "n", "total"])
    return run


def moved_books(books: np.ndarray, state: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codebooks at the floors of their parts' means, how far each entry moved
    at most, and the counts of list places needed.  At most parts * entries
    + 256 sums reach the driver."""
    parts, entries, width = books.shape
    sums = state.select("x", "code", "places").mapInArrow(_sums(parts, entries, width), "part int, entry int, n long, total array<long>")
    rows = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width)]).collect()
    new, needed = books.copy(), np.zeros(256, np.int64)
    for part, entry, n, *total in rows:
        if entry < 0:
            needed[part] = n
        else:
            new[part, entry] = [t // n for t in total]
    return new, np.sqrt(((new - books) ** 2).sum(axis=2)) * (1 + 1e-9) + 1e-9, needed


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes and codebooks: ``vec_id, label, code`` (one byte a part) and
    ``error`` (squared distances summed over parts) per usable row, and the
    final entries (parts x entries x width)."""
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")
    kinds = {"kind": vectors.schema[id_col].dataType.simpleString(),
             "label": vectors.schema[label_col].dataType.simpleString() if label_col in vectors.columns else "int"}
    # unfloored magnitudes, so that nothing is cut to the range of a long
    widest = F.max(F.array_max(F.transform(F.col(vector_col), lambda c: F.when(F.abs(c.cast("double")) < float("inf"), F.abs(c.cast("double"))))))
    rows = integer_rows(vectors, scale, id_col, vector_col, label_col)
    usable = vectors.where(F.forall(vector_col, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))))
    largest, longest = usable.agg(widest, F.max(F.size(vector_col))).first()
    if largest is not None and largest * scale >= LARGEST:
        raise ValueError(f"scaled components must stay below {LARGEST}")
    width = max(1, -(-(longest or 0) // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    books = cut([r["x"] for r in first], parts, width).transpose(1, 0, 2).copy()
    done = "vec_id {kind}, label {label}, code binary, error long".format(**kinds)
    if not first:
        return rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), books
    state_schema = STATE.format(**kinds)
    b_held = b = max(1, min(len(first), -(-entries // 8)))  # an eighth of the entries to begin with
    state = saved(rows.mapInArrow(_first_pass(books, b), state_schema), "codes")
    for turn in range(rounds):
        books, moved, needed = moved_books(books, state)
        if turn:  # the first pass needs no list
            total = np.cumsum(needed[:b + 1])
            b = min(b, max(1, int(np.searchsorted(total, SURE * total[-1]))))
        last = turn == rounds - 1
        step = state.mapInArrow(_next_pass(books, moved.astype(np.float64), b_held, b, last), done if last else state_schema)
        state = saved(step, "codes")
        b_held = b
    if not rounds:
        still = np.zeros(books.shape[:2])
        state = saved(state.mapInArrow(_next_pass(books, still, b_held, b, True), done), "codes")
    return state, books
