import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from farelane.llm import ngram_join as J

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, percent=90, width=3):
    sets = []
    for doc, text in rows:
        w = WORDS.findall((text or "").translate(LOWER))
        sets.append((doc, {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()))
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                up[rb] = ra
    return sorted(((d, len(s), root(d)) for d, s in sets), key=str)


def test_awkward_documents(docs, empty):
    got = J.similarity_components(docs).toPandas()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    as_tuples = sorted(((None if d != d else int(d), int(n), None if c != c else int(c))
                        for d, n, c in got.itertuples(index=False)), key=str)
    assert as_tuples == want
    assert J.similarity_components(empty).count() == 0


def test_near_copies_of_many_sizes_lose_no_link(spark):
    rng = random.Random(5)
    rows = []
    for size in (3, 4, 9, 11, 20, 21, 60, 150, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for copy in range(14):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 14))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(99999)}"
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.86, 1)))]
            rows.append((len(rows) * 3 + 1, " ".join(words).title()))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent, width in ((90, 3), (80, 5)):
        got = sorted(map(tuple, J.similarity_components(df, percent=percent, width=width).collect()), key=str)
        assert got == brute(rows, percent, width)


@given(st.sets(st.integers(0, 2**62), min_size=1, max_size=300), st.sets(st.integers(0, 2**62), max_size=30), st.integers(0, 30))
@settings(max_examples=80, deadline=None)
def test_linked_sets_share_a_cell(common, extra, drop):
    a = np.array(sorted(common), dtype=np.uint64)
    b = np.unique(np.concatenate([a[min(drop, len(a) - 1):], np.array(sorted(extra), dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 90 * (len(a) + len(b) - both):
        limits = J.band_limits()
        assert set(J.cells_of(a, limits, 90).tolist()) & set(J.cells_of(b, limits, 90).tolist())


def test_bound_on_the_symmetric_difference():
    for a in range(1, 60):
        for b in range(a, 60):
            allowed = [a + b - 2 * o for o in range(a + 1) if 100 * o >= 90 * (a + b - o)]
            assert max(allowed, default=0) <= J.most_different(a + b, 90)
