import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from farelane.llm import queries
from farelane.llm import vector_codes as vc


def brute(vectors, parts=16, entries=64, rounds=2, scale=256):
    """(code, error) of each kept (id, vector, label), and the codebooks, in plain loops."""
    import math
    kept = [(i, [math.floor(float(c) * scale) for c in v]) for i, v in vectors]
    d = max((len(x) for _, x in kept), default=0)
    w = max(1, -(-d // parts))
    cut = [[(x + [0] * (parts * w - len(x)))[p * w:(p + 1) * w] for p in range(parts)] for _, x in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], c)), e) for e, c in enumerate(books[p])) for p in range(parts)] for x in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            groups = defaultdict(list)
            for x, codes in zip(cut, found):
                groups[codes[p][1]].append(x[p])
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    return [("".join(f"{e:02x}" for _, e in c), sum(s for s, _ in c)) for c in assign()], books


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, code string")


def test_codes_match_plain_loops(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 32))
    for n, parts, entries, rounds in ((300, 16, 64, 2), (300, 4, 9, 5), (40, 16, 64, 2), (1, 16, 64, 2), (200, 3, 8, 0), (150, 16, 1, 2)):
        x = (centres[rng.integers(0, 12, n)] + rng.normal(scale=rng.choice([0.0, 0.02, 0.5]), size=(n, 32))).astype(np.float32)
        rows = [(int(i), x[i].tolist(), 0, "clash", "c") for i in rng.permutation(n)]
        want, books = brute([(r[0], r[1]) for r in rows], parts, entries, rounds)
        got, made = vc.compress(frame(spark, rows), parts, entries, rounds)
        assert made.tolist() == books
        have = {r.vec_id: (bytes(r.code).hex(), r.error) for r in got.collect()}
        assert have == {r[0]: w for r, w in zip(rows, want)}


def test_ties_repeats_short_vectors_and_nulls(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(20)]), [float(rng.choice([-1, 0, 1])) for _ in range(rng.choice([0, 3, 20, 33]))], None, "", "") for _ in range(200)]
    bad = [(900, None, 1, "", ""), (901, [1.0, None], 1, "", ""), (902, [float("nan")] * 4, 1, "", ""), (903, [float("-inf")] * 4, 1, "", "")]
    want, _ = brute([(r[0], r[1]) for r in rows])
    got = vc.compress(frame(spark, rows + bad))[0].collect()
    key = lambda r: (repr(r[0]), r[1], r[2])
    assert sorted([(r.vec_id, bytes(r.code).hex(), r.error) for r in got], key=key) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=key)


def test_bounds_decide_most_parts_and_never_wrongly():
    rng = np.random.default_rng(5)
    entries = rng.integers(-300, 300, (64, 4))
    x = entries[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 4))
    lists, dist = vc.Lists.of_all(x, entries, 8)
    code = lists.near[:, 0]
    for step in range(6):
        moved = entries + rng.integers(-6, 7, entries.shape) * (step < 5)
        far = np.sqrt(((moved - entries) ** 2).sum(1))
        entries = moved
        if step == 3:
            lists.shrink(4)
        code, dist, places = lists.reassign(x, code, entries, far)
        d = vc.squared(x, entries)
        assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()
        inside = np.take_along_axis(d, lists.near, 1)
        assert (lists.bounds.astype(float) <= np.sqrt(inside)).all()
        out = d.copy()
        np.put_along_axis(out, lists.near, np.iinfo(np.int64).max, 1)
        assert (lists.outer.astype(float) <= np.sqrt(out.min(1).astype(float))).all()
    assert (places == 1).mean() > 0.5


def test_empty_table_and_large_components(spark):
    none = vc.compress(frame(spark, [(1, None, 1, "", "")]))
    assert none[0].count() == 0
    with pytest.raises(ValueError):
        vc.compress(frame(spark, [(1, [3e38, 1.0], 1, "", "")]))


def test_no_label_column(spark):
    assert vc.compress(frame(spark, [(1, [1.0, 2.0], 7, "", "")]).drop("label"))[0].first().label is None


def test_query_matches_its_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{sf}/embeddings.parquet'")
    cols = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE['op13_vector_codes']}) ORDER BY 1").fetchall()
    got = [tuple(r) for r in queries.op13_vector_codes(spark, sf).select(*cols).orderBy("vec_id").collect()]
    assert got == want and hashlib is not None
