"""Periodic runs of words, found on a grammar.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(least_words, repeats * q)`` words that no
neighbouring word extends.  Texts are taken in chunks inside Spark tasks, and
per chunk:

1. Words become ids.  A run's every word lies in a window that comes again in
   its text (see ``_window_words``), so words outside all such windows become
   breaks, which no run can contain.
2. Re-Pair: pairs of neighbouring symbols that come at least twice become
   nonterminals, the more frequent pair first where two overlap, until no pair
   comes twice.  What is left of each stretch is joined by a balanced tree.
3. Per nonterminal, the runs of its words that cross the boundary of its two
   halves are computed once (``crossing``).  Every run crosses the boundary of
   the lowest node of the derivation that holds it.
4. They are translated to all positions where the nonterminal is derived.
5. Intervals of one period that overlap by the period or more are one run; the
   merged ones are maximal.

Word ids are compared, never hashes, so runs are exact; hashes only choose the
windows of step 1, where a collision keeps a word too many.

Defined results: NULL or blank text has no words and no runs; texts of any
length are taken whole.  One result row per input row, repeated rows too, NULL
ids as well.  Columns other than the id and the text are ignored, whatever
their names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import mix

LEAST_WORDS, REPEATS = 24, 3
#: Words that are searched together; a longer text is a chunk of its own.
CHUNK_WORDS = 200_000
Run = tuple[int, int, int]  # first word, end, period


def _window_words(least_words: int, repeats: int) -> int:
    """Words of a window that every run holds twice, one period apart, around
    each of its words: a run of L words has L - q >= L * (1 - 1 / repeats)
    words that come again one period later."""
    return max(1, least_words - least_words // repeats)


def repeated(words: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that comes at least twice
    in the text of the same ``owner``."""
    n = len(words)
    held = np.zeros(n, bool)
    if n <= width:
        return held
    h, have = mix(words.astype(np.uint64) + np.uint64(1)), 1
    while have < width:  # double the window, the last time by less
        step = min(have, width - have)
        h = mix(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
        have += step
    start = np.flatnonzero(owner[:len(h)] == owner[width - 1:])
    h = h[start] ^ mix(owner[start].astype(np.uint64) + np.uint64(0xA5A5))
    ordered = np.sort(h)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(again) == 0:
        return held
    twice = again[np.minimum(np.searchsorted(again, h), len(again) - 1)] == h
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start[twice], 1)
    np.add.at(edge, start[twice] + width, -1)
    return np.cumsum(edge[:-1]) > 0


class Grammar:
    """Rules of symbols: those below ``words`` are words, the others name a
    pair of symbols each."""

    def __init__(self, words: int):
        self.words, self.left, self.right = words, [], []

    def pair(self, a: int, b: int) -> int:
        self.left.append(a)
        self.right.append(b)
        return self.words + len(self.left) - 1


def re_pair(x: np.ndarray, grammar: Grammar) -> np.ndarray:
    """``x`` (negative entries are breaks, each different) with its repeated
    pairs replaced by rules that are put into ``grammar``."""
    while len(x) > 1:
        a, b = x[:-1], x[1:]
        at = np.flatnonzero((a >= 0) & (b >= 0))
        if len(at) == 0:
            break
        base = int(x.max()) + 1
        key = a[at] * base + b[at]
        _, kind, count = np.unique(key, return_inverse=True, return_counts=True)
        # rank: frequent pairs first; equal ranks only for the same pair
        rank = np.zeros(len(x) + 1, np.int64)
        weight = np.where(count > 1, count, 0)
        order = np.empty(len(count), np.int64)
        order[np.argsort(weight, kind="stable")] = np.arange(1, len(count) + 1)
        rank[at + 1] = np.where(weight[kind] > 0, order[kind], 0)
        here, before, after = rank[1:-1], rank[:-2], rank[2:]
        best = (here > 0) & (here >= before) & (here >= after)
        # within a chain of one pair (a a a) every second place
        places = np.flatnonzero(best)
        fresh = np.r_[True, (places[1:] != places[:-1] + 1)]
        first = np.maximum.accumulate(np.where(fresh, places, 0))
        places = places[(places - first) % 2 == 0]
        names, which, used = np.unique(here[places], return_inverse=True, return_counts=True)
        places, which = places[used[which] > 1], which[used[which] > 1]
        if len(places) == 0:
            # the most frequent pair overlaps only itself, or others broke it up: try the pairs one by one
            for k in np.argsort(-weight, kind="stable"):
                if weight[k] == 0:
                    return x
                single = at[kind == k]
                fresh = np.r_[True, single[1:] != single[:-1] + 1]
                first = np.maximum.accumulate(np.where(fresh, single, 0))
                single = single[(single - first) % 2 == 0]
                if len(single) > 1:
                    places, which = single, np.zeros(len(single), np.int64)
                    break
            else:
                return x
        named: dict[int, int] = {}
        for w, p in zip(*np.unique(which, return_index=True)):
            named[int(w)] = grammar.pair(int(x[places[p]]), int(x[places[p] + 1]))
        x = x.copy()
        x[places] = np.array([named.get(w, 0) for w in range(int(which.max()) + 1)], np.int64)[which]
        keep = np.ones(len(x), bool)
        keep[places + 1] = False
        x = x[keep]
    return x


def _same_ahead(x: np.ndarray, i: int, j: int) -> int:
    """Words that agree from places i and j on (i < j)."""
    n, k, block = len(x) - j, 0, 64
    while k < n:
        step = min(block, n - k)
        differ = np.flatnonzero(x[i + k:i + k + step] != x[j + k:j + k + step])
        if len(differ):
            return k + int(differ[0])
        k, block = k + step, 4 * block
    return n


def crossing(x: np.ndarray, cut: int, least_words: int, repeats: int) -> list[Run]:
    """Runs of ``x`` that hold both sides of the boundary before place ``cut``,
    at either end of ``x`` as far as it goes.

    A run holds at least half of its words on one side, which is more than its
    period: with the mirror image, the right side alone need be looked at."""
    found: set[Run] = set()
    n = len(x)
    for y, c, mirrored in ((x, cut, False), (x[::-1], n - cut, True)):
        back = y[::-1]
        # periods whose words begin as the right side does: half of a run less its period agrees
        longest = min(n // repeats, n - c - 1)
        if longest < 1 or n < least_words:
            continue
        q = np.arange(1, longest + 1)
        # that agreement is of 4 words at least, of 8 from period 16 on, of 16 from 32 on
        for ahead, period in (*((k, 0) for k in range(4)), *((k, 16) for k in range(4, 8)), *((k, 32) for k in range(8, 16))):
            at = q + ahead
            q = q[(q < period) | (c + at < n) & (y[np.minimum(c + at, n - 1)] == y[min(c + ahead, n - 1)])]
        while len(q):
            p = int(q[0])
            ahead = _same_ahead(y, c, c + p)
            end = c + p + ahead
            start = c - _same_ahead(back, n - c - p, n - c)
            q = q[1:]
            if start < c and end - start >= max(least_words, repeats * p):
                found.add((n - end, n - start, p) if mirrored else (start, end, p))
                # multiples of the period within its right side give the same stretch again
                q = q[(q % p != 0) | (q > end - c)]
    out: list[Run] = []
    for s, e, p in sorted(found, key=lambda r: r[2]):  # only smallest periods
        if not any(p % q == 0 and a <= s and e <= b for a, b, q in out):
            out.append((s, e, p))
    return out


def runs_of(x: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """Runs of word ids ``x`` (negative entries are breaks, each different):
    rows of first word, end and period, in that order."""
    grammar = Grammar(int(x.max(initial=0)) + 1)
    rest = re_pair(x, grammar)
    # a balanced tree over what is left of every stretch between breaks
    tops: list[tuple[int, int]] = []
    open_ = np.flatnonzero(rest >= 0)
    size: dict[int, int] = {}

    def words(s: int) -> int:
        return 1 if s < grammar.words else size[s]

    for k, (a, b) in enumerate(zip(grammar.left, grammar.right)):
        size[grammar.words + k] = words(a) + words(b)
    lengths = np.where(rest < 0, 1, [words(int(s)) if s >= 0 else 1 for s in rest])
    begins = np.cumsum(lengths) - lengths
    for part in np.split(open_, np.flatnonzero(np.diff(open_) != 1) + 1):
        if len(part) == 0:
            continue
        level = rest[part].tolist()
        while len(level) > 1:
            joined = []
            for i in range(0, len(level) - 1, 2):
                s = grammar.pair(level[i], level[i + 1])
                size[s] = words(level[i]) + words(level[i + 1])
                joined.append(s)
            level = joined + level[len(level) - len(level) % 2:]
        if level[0] >= grammar.words:
            tops.append((level[0], int(begins[part[0]])))
    # where each nonterminal is derived first, and so its words
    n = len(grammar.left)
    places: list[list[np.ndarray]] = [[] for _ in range(n)]
    for s, begin in tops:
        places[s - grammar.words].append(np.array([begin], np.int64))
    first = np.full(n, -1, np.int64)
    for k in range(n - 1, -1, -1):
        if places[k]:
            first[k] = places[k][0][0]
            for child, shift in ((grammar.left[k], 0), (grammar.right[k], words(grammar.left[k]))):
                if child >= grammar.words and not places[child - grammar.words]:
                    places[child - grammar.words].append(np.array([first[k] + shift]))
    own: dict[int, list[Run]] = {}
    wanted = np.zeros(n, bool)  # it or what it derives has runs
    for k in range(n):
        a, b = grammar.left[k], grammar.right[k]
        total = words(a) + words(b)
        if first[k] >= 0 and total >= least_words:
            found = crossing(x[first[k]:first[k] + total], words(a), least_words, repeats)
            if found:
                own[k] = found
        wanted[k] = k in own or any(c >= grammar.words and wanted[c - grammar.words] for c in (a, b))
    # translate: all positions of the nonterminals that matter, from the tops down
    where: list[list[np.ndarray]] = [[] for _ in range(n)]
    for s, begin in tops:
        where[s - grammar.words].append(np.array([begin], np.int64))
    out = []
    for k in range(n - 1, -1, -1):
        if not wanted[k] or not where[k]:
            continue
        at = np.concatenate(where[k])
        where[k] = []
        for child, shift in ((grammar.left[k], 0), (grammar.right[k], words(grammar.left[k]))):
            if child >= grammar.words and wanted[child - grammar.words]:
                where[child - grammar.words].append(at + shift)
        out += [np.column_stack([at + s, at + e, np.full(len(at), q)]) for s, e, q in own.get(k, ())]
    return _merged(np.concatenate(out)) if out else np.empty((0, 3), np.int64)


def _merged(found: np.ndarray) -> np.ndarray:
    """Maximal intervals: those of one period that overlap by it are one."""
    found = found[np.lexsort((found[:, 1], found[:, 0], found[:, 2]))]
    out: list[list[int]] = []
    for s, e, q in found.tolist():
        if out and out[-1][2] == q and s + q <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, q])
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64)


def _of_texts(split: list[list[bytes]], orders: list[np.ndarray | None], least_words: int, repeats: int) -> list[list[Run]]:
    """The runs of every text of a chunk."""
    ids: dict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    coded = []
    for words, order in zip(split, orders):
        x = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        coded.append(x if order is None else x[order])
    sizes = np.array([len(x) for x in coded], np.int64)
    x, begins = np.concatenate(coded), np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(coded)), sizes)
    kept = repeated(x, owner, _window_words(least_words, repeats))
    out: list[list[Run]] = [[] for _ in split]
    if kept.any():
        # one place before each text is a break, so that no run joins two texts
        short = np.flatnonzero(kept)
        new = np.r_[True, (short[1:] != short[:-1] + 1) | (owner[short[1:]] != owner[short[:-1]])]
        at = np.arange(len(short)) + np.cumsum(new)  # places after the breaks are put in
        y = -1 - np.arange(len(short) + int(new.sum()), dtype=np.int64)
        y[at] = np.unique(x[short], return_inverse=True)[1]
        found = runs_of(y, least_words, repeats)
        if len(found):
            back = np.zeros(len(y) + 1, np.int64)
            back[at] = short
            starts = back[found[:, 0]]
            for d, s, e, q in zip(owner[starts].tolist(), starts.tolist(), (starts + found[:, 1] - found[:, 0]).tolist(), found[:, 2].tolist()):
                out[d].append((s - int(begins[d]), e - int(begins[d]), q))
    return out


def _scan(id_col: str, text_col: str, least_words: int, repeats: int, order: Callable[[int | None, int], np.ndarray | None] | None):
    def chunk(held: list, kind: pa.DataType) -> pa.RecordBatch:
        split, orders = [w for _, w, _ in held], [o for _, _, o in held]
        found = _of_texts(split, orders, least_words, repeats) if any(split) else [[] for _ in split]
        kept = []
        for words, at, runs in zip(split, orders, found):
            if at is not None:
                words = [words[i] for i in at.tolist()]
            if runs:
                gone = np.zeros(len(words), bool)
                for s, e, q in runs:
                    gone[s + q:e] = True
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            kept.append(b" ".join(words))
        flat = [r for runs in found for r in runs]
        parts = [pa.array([f(r) for r in flat], pa.int64()) for f in (lambda r: r[0], lambda r: r[1] - r[0], lambda r: r[2])]
        cuts = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        listed = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _, _ in held], kind), pa.array([len(w) for w in split], pa.int64()), listed,
             pa.array(kept, pa.binary())], names=[id_col, "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, words, kind = [], 0, batch.schema.field(id_col).type
            for i, text in zip(batch.column(id_col).to_pylist(), batch.column(text_col)):
                split = (text.as_py() or b"").split()  # bytes split at ASCII white space alone
                held.append((i, split, order(i, len(split)) if order else None))
                words += len(split)
                if words >= CHUNK_WORDS:
                    yield chunk(held, kind)
                    held, words = [], 0
            if held:
                yield chunk(held, kind)
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
              repeats: int = REPEATS, order: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """Per row: id, n_words, ``runs`` (array of start, length and period, by
    start, then period; words count from 0) and ``collapsed``, the words but
    those that a run holds after its first period, joined by one blank.

    ``order(id, n_words)``, if given, says in which order (with repetitions)
    the words are read, or None for their own.  ``repeats`` is at least 3: the
    boundary search rests on it."""
    if repeats < 3 or least_words < 8 * repeats:
        raise ValueError("runs need at least three repeats and eight words for each")
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(docs[id_col], docs[text_col].cast("binary").alias(text_col)).mapInArrow(
        _scan(id_col, text_col, least_words, repeats, order),
        f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
