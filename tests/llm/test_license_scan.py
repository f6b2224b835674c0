import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from farelane.llm import license_scan as L

FIND = re.compile(L.WORDS)
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(text, templates=L.TEMPLATES, block=L.BLOCK_WORDS):
    words = FIND.findall((text or "").translate(UPPER))
    base = sorted((label, i) for phrase, label in L.BASE_PHRASES.items() for i in range(len(words))
                  if tuple(words[i:i + len(phrase)]) == phrase)
    found = set()
    for start in L.block_starts(len(words), block):
        held = set(words[start:start + block])
        here = []
        for t, (label, template) in enumerate(templates):
            own = set(L.words_of(template))
            if len(own & held) >= math.ceil(L.THRESHOLD * len(own) - 1e-9):
                here.append((label, t, own, len(own & held) / len(own)))
        for label, t, own, c in here:
            beaten = any(d > c and other != label and len(own & o) >= math.ceil(L.THRESHOLD * max(len(own), len(o)) - 1e-9) for other, _, o, d in here)
            if not beaten:
                found.add((label, t, start, round(c, 9)))
    return len(words), base, sorted(found)


def texts():
    rng = random.Random(1)
    fill = [f"w{i}" for i in range(50)] + ["the", "of", "software", "license", "under", "MIT", "Public"]
    out = ["", None, "MIT License", "mit-license, MIT\nlicense; general PUBLIC license", "license mit"]
    for label, template in L.TEMPLATES:
        words = template.split()
        for drop in (0, 1, 3):
            kept = [w for i, w in enumerate(words) if i >= drop]
            rng.shuffle(kept)
            pad = [rng.choice(fill) for _ in range(rng.randrange(0, 150))]
            out.append(" ".join(pad + kept + pad[::-1]))
    return out


def test_against_every_template_in_every_block(spark, docs, empty):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frame in (df, docs):
        given_texts = {r.doc_id: r.text for r in frame.collect()}
        got = L.scan(frame).collect()
        assert len(got) == frame.count()
        for r in got:
            n, base, found = plain(given_texts[r.doc_id])
            assert r.n_words == n
            assert sorted((p.label, p.first_word) for p in r.places) == base
            assert sorted((f.label, f.template, f.first_word, round(f.containment, 9)) for f in r.found) == found
    assert L.scan(empty).count() == 0


@given(st.integers(0, 400), st.integers(0, 399), st.integers(1, 32))
@settings(max_examples=200, deadline=None)
def test_half_a_block_lies_whole_in_one(n, at, size):
    if at + size <= n:
        assert any(s <= at and at + size <= s + 64 for s in L.block_starts(n, 64))


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 65, 97, 128, 129])
def test_blocks_of_places_are_the_blocks(n):
    got = L.blocks_of([(i, str(i)) for i in range(n)], n, 64)
    assert got == {s: {str(i) for i in range(s, min(n, s + 64))} for s in L.block_starts(n, 64)}


@given(st.lists(st.sampled_from("abcdefghij"), max_size=12), st.permutations("abcdefghij"))
@settings(max_examples=200, deadline=None)
def test_filters_lose_nothing_in_any_order(words, order):
    templates = [("x", "a b c d e"), ("y", "c d"), ("z", "f g h i j a")]
    index = L.Templates(templates, {w: i for i, w in enumerate(order)}, 0.8)
    want = {(t, len(set(x.split()) & set(words))) for t, (_, x) in enumerate(templates)
            if len(set(x.split()) & set(words)) >= math.ceil(0.8 * len(set(x.split())))}
    assert {(t, round(c * len(index.sets[t]))) for t, c in index.found(set(words))} == want


def test_related_notices_have_their_own_labels(spark):
    notices = {label: text for label, text in L.TEMPLATES if label in ("gpl", "lgpl") and "redistribute" in text}
    df = spark.createDataFrame([(1, notices["gpl"]), (2, notices["lgpl"]), (3, notices["gpl"] + " " + " ".join(f"x{i}" for i in range(90)) + " " + notices["lgpl"])],
                               "doc_id long, text string")
    got = {r.doc_id: {f.label for f in r.found} for r in L.scan(df).collect()}
    assert got == {1: {"gpl"}, 2: {"lgpl"}, 3: {"gpl", "lgpl"}}


@pytest.mark.parametrize("at", [0, 1, 37, 50, 99, 100, 101, 250])
def test_a_long_template_is_found_wherever_it_stands(spark, at):
    template = " ".join(f"term{i}" for i in range(100))
    text = " ".join(f"fill{i}" for i in range(at)) + " " + template + " " + " ".join(f"more{i}" for i in range(130))
    got = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), [("long", template), ("short", "nowhere at all")]).first()
    assert {(f.label, f.containment) for f in got.found if f.containment == 1} == {("long", 1.0)}
    assert L.block_words([("long", template)]) == 200 and L.block_words(L.TEMPLATES) == 64
