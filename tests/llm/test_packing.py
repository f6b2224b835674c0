import math
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from farelane.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_the_tokenizer_on_whole_texts(docs):
    tokenizer = Tokenizer.from_file(PATH)
    got = {}
    for r in packing.token_pieces(docs, PATH, with_ids=True).collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc, text in {(r.doc_id, r.text) for r in docs.collect()}:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(got[doc], key=lambda r: r.piece)
        if doc == 12:  # repeated row
            pieces = pieces[::2]
        assert [i for p in pieces for i in p.ids] == ids
        assert [p.start for p in pieces] == list(range(0, len(ids), 2048))
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())


def test_every_piece_is_packed_once_without_gaps(docs, empty):
    packed = packing.pack(packing.token_pieces(docs, PATH)).toPandas()
    assert len(packed) == packing.token_pieces(docs, PATH).count()
    for _, g in packed.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= 2048
        assert (g["length"].cumsum() - g["length"] == g["offset"]).all()
    assert packing.pack(packing.token_pieces(empty, PATH)).count() == 0


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(max_examples=60, deadline=None)
def test_best_fit_decreasing_against_a_plain_loop(sizes):
    bins, offsets, fill = packing.best_fit_decreasing(np.array(sizes, dtype=np.int64), 40)
    room: list[int] = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in room if r >= s]
        if fits:
            room[room.index(min(fits))] -= s
        else:
            room.append(40 - s)
    assert sorted(40 - f for f in fill) == sorted(room)
    for b in set(bins.tolist()):
        parts = sorted((o, s) for o, s, x in zip(offsets, sizes, bins) if x == b)
        assert [o for o, _ in parts] == [sum(s for _, s in parts[:i]) for i in range(len(parts))]


def _optimum(sizes, capacity):
    best = len(sizes)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(sizes):
            best = len(room)
            return
        for r in sorted({x for x in room if x >= sizes[i]}):
            j = room.index(r)
            place(i + 1, room[:j] + [r - sizes[i]] + room[j + 1:])
        place(i + 1, room + [capacity - sizes[i]])
    place(0, [])
    return best


@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
@settings(max_examples=60, deadline=None)
def test_lower_bound_never_exceeds_the_optimum(sizes):
    bound = packing.lower_bound(np.array(sizes), 12)
    assert math.ceil(sum(sizes) / 12) <= bound <= _optimum(sorted(sizes, reverse=True), 12)


def test_bound_sees_items_that_cannot_share():
    assert packing.lower_bound(np.array([1025] * 10), 2048) == 10
    assert packing.lower_bound(np.array([700] * 9), 2048) == 5


def test_partitions_with_gaps_exchange(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, 0, int(s), i) for i, s in enumerate(rng.integers(1, 900, 3000))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = packing.pack(pieces, group_rows=150).toPandas()
    assert len(packed) == 3000
    total = sum(r[3] for r in rows)
    assert packed.sequence_id.nunique() <= math.ceil(total / 2048) + 1  # 20 groups packed apart would leave up to 20 more


def test_sequences_hold_the_ids(docs):
    pieces = packing.token_pieces(docs.where("doc_id in (1, 3, 11)"), PATH, with_ids=True)
    packed = packing.pack(pieces)
    got = {r.sequence_id: r.ids for r in packing.sequences(packed, pieces).collect()}
    want = {r.sequence_id: 0 for r in packed.collect()}
    for r in packed.collect():
        want[r.sequence_id] += r.length
    assert {k: len(v) for k, v in got.items()} == want


@pytest.mark.parametrize("n", [0, 1])
def test_bound_of_little(n):
    assert packing.lower_bound(np.array([5] * n, dtype=np.int64), 10) == n


def _same_ids(words):
    tokenizer = Tokenizer.from_file(PATH)
    table = packing.WordIds(tokenizer)
    for at in range(0, len(words), 2000):
        some = words[at:at + 2000]
        want = tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
        assert table.of(some)[0].tolist() == want, [w for w in some if table.of([w])[0].tolist() != tokenizer.encode(w, add_special_tokens=False).ids]


def test_words_of_every_code_point_match_the_library():
    points = [chr(c) for c in range(33, 0x110000) if not 0xD800 <= c < 0xE000 and not chr(c).isspace() and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    _same_ids([w for c in points for w in (f"{c}.", f"a{c}!b", f"Zz{c}***")])


def test_letters_with_every_mark_match_the_library():
    marks = [chr(c) for c in range(0x300, 0x1F000) if unicodedata.category(chr(c)).startswith("M")]
    _same_ids([w for m in marks for letter in "aÉİΣकড়가ß" for w in (f"{letter}{m}.", f"x{letter}{m}", f"{m}{letter}'s")])


@given(st.lists(st.text(st.sampled_from("abÀéßİΣक़ড়'<|>.,!-*0²ªµ़́\t "), max_size=8), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_mixed_words_match_the_library(words):
    _same_ids([w for w in words if not w.isspace()] or ["a"])


def test_forgotten_words_are_learned_again():
    tokenizer = Tokenizer.from_file(PATH)
    table = packing.WordIds(tokenizer, 3, 2)
    for text in ("one two three four, five.", "two SIX seven!", "one one two"):
        assert table.of(text.split(" "))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_repeated_rows_are_spread_and_certified(spark, monkeypatch):
    rows = [(7, 0, 0, 1000, 99)] * 1000
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    groups, counted = [], packing.saved

    def looked_at(df, label):
        out = counted(df, label)
        if label == "packed" and not groups:
            groups.extend(r["count"] for r in out.groupBy("part").count().collect())
        return out
    monkeypatch.setattr(packing, "saved", looked_at)
    packed = packing.pack(pieces, group_rows=100).toPandas()
    assert len(groups) == 10 and max(groups) < 200
    assert len(packed) == 1000 and packed.sequence_id.nunique() == 500
    small = packing.pack(spark.createDataFrame(rows[:5], pieces.schema)).toPandas()
    assert small.sequence_id.nunique() == 3 and small.certified.all()


def test_a_group_above_its_bound_is_not_certified():
    import pandas as pd
    # 6 + 4 and 5 + 3 + 2 fill two sequences; best fit leaves 4 + 5 and a third
    for sizes in ([6, 5, 4, 3, 2], [6, 6, 4, 4], [5, 5, 5], [4, 4, 4, 3, 3, 2]):
        n = len(sizes)
        frame = pd.DataFrame({"doc_id": range(n), "piece": 0, "start": 0, "length": sizes, "ids_crc32": 0, packing.ROW: range(n)})
        got = packing._pack_group(10, "doc_id")(frame)
        assert (got["certified"] == (got["bin"].nunique() == packing.lower_bound(np.array(sizes), 10))).all()
