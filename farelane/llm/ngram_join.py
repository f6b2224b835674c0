"""N-gram Jaccard join with parity sketches.

A document is the set of its distinct word shingles, hashed to 64 bits.
Hashing every shingle to a cell of a sketch and XOR-ing what falls there makes
a sketch whose differing cells number at most the symmetric difference of the
sets.  Sets of Jaccard ``t`` or more differ in at most
``(1 - t) / (1 + t) * (|A| + |B|)`` shingles.  Per size band, the sketch has
more cells than that bound for the band's largest sets, so two linked
documents agree in at least one whole cell (pigeonhole): equal cells give the
candidates, and no link is lost.  A document near the end of its band also
sends the cells of the next band.

Empty cells are not sent, so every key depends on content.  A document with
more non-empty cells than the bound agrees with each partner in one of them;
one with fewer also sends the cells of another sketch, with another hash, and
so on.  Of two partners, the one that needs fewer sketches has such a cell in
a sketch that both send.  Cells beyond the bound are spare: a document with no
more hot cells than spare ones needs no hot cell either (see
``common.shared_cells``), so a passage that many documents share does not
bring them together in pairs.

Equal sets are one node, named by the first half of a 128-bit set hash.
Members of a cell are held against the cell's smallest id, then against other
members while their components differ (see ``common.cell_components``).
Lengths and a 512-bit parity sketch rule out most pairs in the join, a parity
sketch as wide as the sets need most of the rest, and the shingle hashes
decide.

Defined results: NULL or empty text, or text without words, has no shingles
and links with nothing; with fewer words than a shingle the whole sequence is
one.  A NULL id links with nothing.  One result row per input row, repeated
rows too; rows of one id with different texts are different nodes.  Columns
other than the id and the text are ignored.  An empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Run, cell_components, shared_cells, slices, worker_cache

WORDS = r"[^\x20\x09-\x0D]+"
#: Neighbouring band limits; wider bands need fewer cells sent twice but looser bounds.
BAND_RATIO = 1.4
SKETCH_WORDS = 8
#: Cells beyond the bound, as a share of it; sketches that a document sends at most.
SPARE, SKETCHES = 0.25, 8
CACHE_WORDS = 400_000


def band_limits(top: int = 1 << 31) -> np.ndarray:
    """Lower limits of the size bands: integers growing by BAND_RATIO."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO)))
    return np.array(out, dtype=np.int64)


def most_different(sizes: int, percent: int) -> int:
    """Largest symmetric difference of two sets whose sizes sum to ``sizes``
    and whose Jaccard similarity is at least ``percent`` / 100."""
    return (100 - percent) * sizes // (100 + percent)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of a word-hash sequence's shingles."""
    if len(words) == 0:
        return words
    n = max(1, len(words) - width + 1)
    h = np.full(n, min(len(words), width), dtype=np.uint64)
    for i in range(min(width, len(words))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return np.unique(h)


def set_hash(s: np.ndarray) -> tuple[int | None, int | None]:
    """128 bits that name a set of shingle hashes; none for the empty set."""
    if len(s) == 0:
        return None, None
    return (int(np.bitwise_xor.reduce(mix(s)).view(np.int64)),
            int(np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)))


def _word_hasher():
    import xxhash
    table = worker_cache("word_hashes")
    find = re.compile(WORDS).findall
    lower = {c: c + 32 for c in range(65, 91)}

    def hashes(text: str | None) -> np.ndarray:
        text = text or ""
        words = find(text.lower() if text.isascii() else text.translate(lower))
        try:
            return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(table) > CACHE_WORDS:
                table.clear()
            for w in set(words):
                if w not in table:
                    table[w] = xxhash.xxh64_intdigest(w)
            return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    return hashes


def keyed_cells(s: np.ndarray, limits: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set's sketch cells, its own band's and the next one's if a
    larger partner there is possible, and beside each its tag: 16 * (spare
    cells + 1) + family, where a family is the cells of one sketch and band."""
    n = len(s)
    band = int(np.searchsorted(limits, n, side="right")) - 1
    keys, tags = [], []
    for b in (band, band + 1):
        if b > band and 100 * n < percent * int(limits[b]):
            break
        bound = most_different(2 * (int(limits[b + 1]) - 1), percent)
        k = bound + 1 + max(1, int(SPARE * (bound + 1)))
        for sketch in range(SKETCHES):
            h = mix(s + np.uint64(sketch * 0x9E3779B97F4A7C15 % (1 << 64))) if sketch else s
            spread = mix(h ^ np.uint64(0xD6E8FEB86659FD93))
            cell = (h % np.uint64(k)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            held = cell[order]
            first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
            parity = np.bitwise_xor.reduceat(spread[order], first)
            places = held[first].astype(np.uint64)
            spare = len(first) - bound - 1
            if spare < 0 and sketch == SKETCHES - 1:  # all cells of the last one: the plain pigeonhole
                whole = np.zeros(k, np.uint64)
                whole[held[first]] = parity
                parity, places = whole, np.arange(k, dtype=np.uint64)
            keys.append(mix(parity + mix(places + np.uint64((b << 40) + (sketch << 36)))))
            tags.append(np.full(len(parity), 16 * (max(spare, -1) + 1) + 2 * sketch + b - band, np.int32))
            if spare >= 0:
                break
    return np.concatenate(keys), np.concatenate(tags)


def cells_of(s: np.ndarray, limits: np.ndarray, percent: int) -> np.ndarray:
    """The keys alone."""
    return keyed_cells(s, limits, percent)[0]


def _sets(id_col: str, text_col: str, width: int, percent: int):
    """Per row: size, 128-bit set hash and the cells; of equal sets in one
    task only the first carries its cells, which thins out hot copies."""
    limits = band_limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hasher()
        seen: set = set()
        for batch in slices(batches, text_col):
            sizes, h1, h2, cells, tags = [], [], [], [], []
            if len(seen) > CACHE_WORDS:
                seen.clear()
            for text in batch.column(text_col).to_pylist():
                s = shingle_hashes(hashes(text), width)
                key = (len(s), *set_hash(s))
                for to, v in zip((sizes, h1, h2), key):
                    to.append(v)
                found = (None, None) if key in seen or not len(s) else keyed_cells(s, limits, percent)
                cells.append(found[0] if found[0] is None else found[0].view(np.int64))
                tags.append(found[1])
                seen.add(key)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(cells, pa.list_(pa.int64())), pa.array(tags, pa.list_(pa.int32()))],
                names=[id_col, "n_shingles", "h1", "h2", "cells", "tags"])
    return run


def parity(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity sketch of a set, as bytes; ``bits`` is a power of two."""
    at = (mix(s) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little")


def width_of(size: int, percent: int) -> int:
    """Bits of a set's wide sketch: several for each difference allowed."""
    return 1 << max(9, (8 * most_different(2 * size, percent)).bit_length())


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """Differing bits of two parity sketches; the wider is folded, which keeps
    it a parity sketch."""
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _hash_lists(text_col: str, width: int, percent: int):
    """Per node: size, sketches and all hashes; a task sends each node once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hasher()
        seen: set[int | None] = {None}
        for batch in slices(batches, text_col):
            ids, raw, sketch, wide = [], [], [], []
            for text in batch.column(text_col).to_pylist():
                s = shingle_hashes(hashes(text), width)
                node = set_hash(s)[0]
                if node in seen:
                    continue
                seen.add(node)
                ids.append(node)
                raw.append(s.tobytes())
                sketch.append(parity(s, 64 * SKETCH_WORDS).view(np.int64))
                wide.append(parity(s, width_of(len(s), percent)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(r) // 8 for r in raw], pa.int64()), pa.array(sketch, pa.list_(pa.int64())),
                 pa.array(wide, pa.binary()), pa.array(raw, pa.binary())], names=["id", "n", "sketch", "wide", "hashes"])
    return run


def _close(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b, n in zip(batch.column("wa"), batch.column("wb"), batch.column("n").to_pylist()):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (a, b))
                ok.append(differing(x, y) <= most_different(n, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("ha"), batch.column("hb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                both = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                ok.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _may_link(n1: Column, n2: Column, s1: Column, s2: Column, percent: int) -> Column:
    """What sizes and parity sketches leave possible.  The differing bits of
    two parity sketches never exceed the symmetric difference."""
    far = sum((F.bit_count(s1[i].bitwiseXOR(s2[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * far <= (100 - percent) * (n1 + n2))


def similarity_components(docs: DataFrame, percent: int = 90, width: int = 3, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` for every row: the smallest id
    reachable by links of Jaccard ``percent`` / 100 or more (integer ids)."""
    run = Run(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col), F.col(text_col))
    keyed = run.saved(docs.mapInArrow(_sets(id_col, text_col, width, percent),
                                      f"`{id_col}` {kind}, n_shingles long, h1 long, h2 long, cells array<long>, tags array<int>"), "keyed")
    # Copies in other tasks repeat their cells; the node is the same.
    cells = keyed.where("cells IS NOT NULL").select(F.col("h1").alias("id"), F.inline(F.arrays_zip("cells", "tags")))
    shared = shared_cells(cells.select("id", F.col("tags").bitwiseAND(F.lit(15)).alias("family"),
                                       (F.shiftright("tags", 4) - 1).alias("spare"), F.col("cells").alias("cell")), run)
    sets = run.saved(keyed.drop("cells", "tags"), "sets")
    run.drop(keyed)
    # One row stands for each node that shares a cell; its text is read again.
    stands = (sets.where(f"n_shingles > 0 AND `{id_col}` IS NOT NULL").groupBy("h1").agg(F.min(id_col).alias("stand"))
              .join(shared.select(F.col("id").alias("h1")).distinct(), "h1", "left_semi").select("stand").distinct())
    texts = docs.select(F.col(id_col).alias("stand"), F.col(text_col).alias("text")).join(stands, "stand", "left_semi")
    lists = run.saved(texts.mapInArrow(
        _hash_lists("text", width, percent), "id long, n long, sketch array<long>, wide binary, hashes binary"), "hashes")

    def sides(pairs: DataFrame, column: str, *more: str) -> DataFrame:
        for s in "ab":
            pairs = pairs.join(lists.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in (column, *more)]), s)
        return pairs

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        close = (sides(pairs, "wide", "n").select("a", "b", F.col("wide_a").alias("wa"), F.col("wide_b").alias("wb"), (F.col("n_a") + F.col("n_b")).alias("n"))
                 .mapInArrow(_close(percent), "a long, b long"))
        close = run.saved(close, "close")
        out = run.saved(sides(close, "hashes").select("a", "b", F.col("hashes_a").alias("ha"), F.col("hashes_b").alias("hb"))
                        .mapInArrow(_linked(percent), "a long, b long"), label)
        run.drop(close)
        return out

    whole = cell_components(shared, lists.select("id", "n", "sketch"),
                            lambda x, y: _may_link(x("n"), y("n"), x("sketch"), y("sketch"), percent), verified, run)
    run.drop(shared, lists)
    # The smallest document id of each node, then of each component.
    nodes = sets.where(f"n_shingles > 0 AND `{id_col}` IS NOT NULL").groupBy("h1", "h2").agg(F.min(id_col).alias("first"))
    reached = nodes.join(whole.withColumnRenamed("id", "h1"), "h1", "left").withColumn("c", F.coalesce("component", "h1"))
    least = reached.groupBy("c").agg(F.min("first").alias("component_id"))
    named = reached.join(least, "c").select("h1", "h2", "component_id")
    found = sets.where(f"n_shingles > 0 AND `{id_col}` IS NOT NULL").join(named, ["h1", "h2"]).select(id_col, "n_shingles", "component_id")
    none = sets.where(f"n_shingles = 0 OR `{id_col}` IS NULL").select(id_col, "n_shingles", F.col(id_col).alias("component_id"))
    return run.result(found.unionByName(none))
