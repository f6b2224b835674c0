"""Best-fit packing of token sequences with certified bin counts.

Documents become token ids (word BPE, one separator id 0 at the end); only a
document above the capacity is cut, into full pieces and a shorter last one.
Full pieces are sequences of their own.  The rest is packed in partitions by
best-fit decreasing; dual-feasible functions give a lower bound on every
partition's sequences.  Partitions with gaps -- more sequences than the bound,
and the loosest sequence of each partition -- exchange their documents and are
packed again, until one group is left or a round gains nothing.

Defined results: NULL text counts as empty (its only id is the separator);
every input row is packed, repeated rows too; an empty table gives no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, worker_cache

CAPACITY = 2048
#: Pieces that one task packs together.
GROUP_ROWS = 100_000
ROW = "packing__row"
#: Distinct words, and parts of words, that a Python worker remembers (about 200 bytes each).
CACHE_WORDS, CACHE_PARTS = 500_000, 500_000
#: Words of these characters alone split into PARTS exactly where the pre-tokenizer splits.
SIMPLE = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~]+| ")
#: Parts that one call encodes, characters of texts that are looked up together.
CALL_PARTS, CHUNK_CHARS = 20_000, 1_000_000


def word_parts(word: str) -> list[str] | None:
    """The parts of a word that is not SIMPLE if the tokenizer encodes them
    apart and they stay themselves under its normalizer: letters and ASCII
    punctuation behind them.  None if only the whole word is safe.

    Lower-casing and composing can give a letter a mark, which would join what
    follows it: such words are not split."""
    core = word.rstrip(".,!?;:")
    plain = unicodedata.normalize("NFC", core).lower()
    if not core.isalpha() or not plain.isalpha() or unicodedata.normalize("NFC", plain) != plain or "Σ" in core:
        return None
    return [plain, word[len(core):]] if len(core) < len(word) else [plain]


class IdTable:
    """Ids of strings, each encoded once: a number per string, and per number
    where its ids lie."""

    def __init__(self, tokenizer, most: int):
        self.tokenizer, self.most = tokenizer, most
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.flat, self.starts, self.lengths = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def whole(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings, one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), "<u4"), np.array(list(map(len, ids)), np.int64)

    def learn(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.whole(strings)

    def of(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``whole``, by the table; new strings are learned first."""
        if len(self.numbers) > self.most:
            self.clear()
        known = len(self.starts)
        x = np.fromiter(map(self.numbers.__getitem__, strings), np.int64, len(strings))
        if len(self.numbers) > known:
            ids, lengths = self.learn(list(islice(self.numbers, known, None)))
            self.starts = np.append(self.starts, len(self.flat) + np.cumsum(lengths) - lengths)
            self.lengths = np.append(self.lengths, lengths)
            self.flat = np.append(self.flat, ids)
        return ragged(self.flat, self.starts[x], self.lengths[x]), self.lengths[x]


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat``, one after another."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class PartIds(IdTable):
    """Parts that the tokenizer encodes apart; a blank has no ids."""

    def __init__(self, tokenizer, most: int):
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)  # whether a token ends a part
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        super().__init__(tokenizer, most)

    def learn(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many parts in one call; each one's last token ends a part."""
        ids, lengths = [], []
        for at in range(0, len(strings), CALL_PARTS):
            some = strings[at:at + CALL_PARTS]
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(found) or " " in some:
                found, sizes = self.whole(some)
            else:
                sizes = np.diff(cuts, prepend=0)
            ids.append(found)
            lengths.append(sizes)
        return np.concatenate(ids), np.concatenate(lengths)


class WordIds(IdTable):
    """White-space separated words, new ones by their parts where that is safe."""

    def __init__(self, tokenizer, most: int = CACHE_WORDS, most_parts: int = CACHE_PARTS):
        super().__init__(tokenizer, most)
        self.parts = PartIds(tokenizer, most_parts)

    def learn(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple = SIMPLE.fullmatch
        kind = np.array([0 if simple(w) else 1 for w in strings])
        tokens = PARTS.findall(" ".join([w for w, k in zip(strings, kind.tolist()) if k == 0]).lower())
        for i in np.flatnonzero(kind).tolist():
            split = word_parts(strings[i])
            if split is None:
                kind[i] = 2
            else:
                tokens += [" ", *split] if tokens else split
        ids, lengths = self.parts.of(tokens)
        blank = np.array([t == " " for t in tokens], bool)
        # a word's ids end before the next blank
        ends = np.cumsum(lengths)[np.append(np.flatnonzero(blank), len(tokens) - 1)] if tokens else np.empty(0, np.int64)
        rest, more = self.whole([strings[i] for i in np.flatnonzero(kind == 2).tolist()])
        # simple words first, then split ones, then whole ones: back to their order
        order = np.argsort(kind, kind="stable")
        sizes = np.append(np.diff(ends, prepend=0), more)
        flat, starts = np.append(ids, rest), np.cumsum(sizes) - sizes
        back = np.argsort(order, kind="stable")
        return ragged(flat, starts[back], sizes[back]), sizes[back]


def _piece_batches(tokenizer_file: str, capacity: int, id_col: str, text_col: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache = worker_cache("word_ids")
        if tokenizer_file not in cache:
            cache[tokenizer_file] = WordIds(Tokenizer.from_file(tokenizer_file))
        table = cache[tokenizer_file]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out: dict[str, list] = {k: [] for k in ("doc", "piece", "start", "length", "crc", "ids")}
            for texts in _chunks(zip(batch.column(id_col).to_pylist(), batch.column(text_col))):
                split = [t.replace("\n", " ").split(" ") for _, t in texts]
                # one look-up for the texts of a chunk
                sizes = np.array(list(map(len, split)), np.int64)
                ids, words = table.of(list(chain.from_iterable(split)))
                ends = np.cumsum(words)[np.cumsum(sizes) - 1]
                for (doc, _), first, last in zip(texts, np.append(0, ends[:-1]).tolist(), ends.tolist()):
                    raw = ids[first:last].tobytes() + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at:at + 4 * capacity]
                        out["doc"].append(doc)
                        out["piece"].append(k)
                        out["start"].append(k * capacity)
                        out["length"].append(len(part) // 4)
                        out["crc"].append(zlib.crc32(part))
                        if with_ids:
                            out["ids"].append(np.frombuffer(part, dtype="<i4"))
            cols = [pa.array(out["doc"], batch.schema.field(id_col).type), pa.array(out["piece"], pa.int32()),
                    pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()), pa.array(out["crc"], pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(out["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (id, text) in lists of about CHUNK_CHARS characters; a longer text is alone."""
    held, size = [], 0
    for doc, text in rows:
        held.append((doc, text := text.as_py() or ""))
        size += len(text)
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ``ids``)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(id_col, text_col).mapInArrow(
        _piece_batches(tokenizer_file, capacity, id_col, text_col, with_ids), schema)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that ``sizes`` need at least: the best of three families of
    dual-feasible functions (identity, rounding up to k-ths, and thresholds
    that count items above ``capacity - t`` whole and items below ``t`` as
    nothing), taken over the histogram of sizes."""
    if len(sizes) == 0:
        return 0
    n = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * x).sum()) // capacity)
    for k in range(1, 21):
        up = (k + 1) * x
        whole = up % capacity == 0
        # in units of 1 / (k * capacity); an exact multiple keeps its size
        value = np.where(whole, k * x, up // capacity * capacity)
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    total, count = np.cumsum(n * x), np.cumsum(n)
    t = np.arange(1, capacity // 2 + 1)
    large = count[-1] - count[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    return max(best, int((large + -(-middle // capacity)).max()))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin.

    Bins are stacked by their room; a bit mask of the rooms in use finds the
    tightest fit in a few machine words, whatever the number of bins."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, room = 0, []
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        room[b] = r - size
        if room[b]:
            stacks[room[b]].append(b)
            mask |= 1 << room[b]
    return bins, offsets, capacity - np.array(room, dtype=np.int64)


def _pack_group(capacity: int, id_col: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([id_col, "piece", "ids_crc32", ROW], kind="stable")  # a task that runs again gives the same bins
        sizes = pdf["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(sizes, capacity)
        excess = len(fill) > lower_bound(sizes, capacity)
        loose = (fill < capacity) & excess
        loose[np.argmin(fill)] |= fill.min() < capacity
        return pdf.assign(bin=bins, offset=offsets, loose=loose[bins], certified=not excess)
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, id_col: str = "doc_id",
         max_rounds: int = 12) -> DataFrame:
    """``pieces`` (id, piece, start, length, ids_crc32) with sequence_id,
    offset, and ``certified``: whether the group of pieces in which the
    sequence was packed met its lower bound.  Pieces are dealt to groups by a
    row number that the saved table fixes, equal rows apart, so a group never
    holds much more than ``group_rows`` pieces."""
    cols = [id_col, "piece", "start", "length", "ids_crc32"]
    pieces = saved(pieces.select(*cols, F.monotonically_increasing_id().alias(ROW)), "pieces")
    whole = pieces.where(F.col("length") >= capacity)
    todo = pieces.where(F.col("length") < capacity)
    # a sequence id holds round, group and bin; those of full pieces are negative
    settled = [whole.select(*cols, (-1 - F.col(ROW)).alias("sequence_id"),
                            F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) \
        + ", part long, bin long, offset long, loose boolean, certified boolean"
    held: DataFrame | None = None
    for turn in range(max_rounds):
        n = todo.count()
        if n == 0:
            break
        parts = -(-n // group_rows)
        salted = todo.withColumn("part", F.pmod(F.xxhash64(ROW, F.lit(turn)), F.lit(parts)).cast("long"))
        packed = saved(salted.groupBy("part").applyInPandas(_pack_group(capacity, id_col), out_schema), "packed")
        name = (F.lit(turn).cast("long") * F.lit(1 << 56) + F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id")
        packed = packed.select(*cols, ROW, name, "offset", "loose", "certified")
        if held is not None:
            before, after = (x.agg(F.count_distinct("sequence_id")).first()[0] for x in (held, packed))
            if after >= before:  # the exchange gained nothing: the earlier sequences stay
                break
            held = None
        settled.append(packed.where(~F.col("loose")).select(*cols, "sequence_id", "offset", "certified"))
        held = packed.where("loose")
        todo = held.select(*cols, ROW)
        if parts == 1:
            break
    if held is not None:
        settled.append(held.select(*cols, "sequence_id", "offset", "certified"))
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out


def sequences(packed: DataFrame, pieces_with_ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids in order."""
    spans = packed.select(id_col, "piece", "sequence_id", "offset")
    joined = pieces_with_ids.select(id_col, "piece", "ids").join(spans, [id_col, "piece"])
    return joined.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])).alias("ids"))
