import hashlib
import random
import zlib

import numpy as np
import pytest

from farelane.llm import periodic_runs as pr
from farelane.llm import queries


def brute(words, least=24, repeats=3):
    """All maximal stretches with each period, then only smallest periods."""
    n, found = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, repeats * q):
                found.append((s, i + q, q))
    small = [(s, e, q) for s, e, q in found if not any(q % p == 0 and p < q and a <= s and e <= b for a, b, p in found)]
    return sorted(small, key=lambda r: (r[0], r[2]))


def got(words):
    return [tuple(r) for r in pr._of_texts([[str(w).encode() for w in words]], [None], 24, 3)[0]]


def planted(rng):
    words = []
    for _ in range(rng.randint(1, 7)):
        unit = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13, 40]))]
        part = unit * rng.choice([1, 2, 3, 4, 9, 30])
        if rng.random() < 0.4:  # runs of runs
            part = (part + [rng.choice("xyz")] * rng.randint(0, 2)) * rng.choice([1, 3, 4])
        words += part[:rng.randint(1, len(part))]
        words += [str(rng.random())] * rng.choice([0, 0, 1])
    return words


def test_runs_match_the_plain_definition():
    rng = random.Random(5)
    total = 0
    for _ in range(400):
        words = planted(rng)
        want = brute(words)
        total += len(want)
        assert got(words) == want, words
    assert total > 400


@pytest.mark.parametrize("words", [
    [], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 12, ["a", "b"] * 11 + ["a"], list("abcdefgh") * 3, list("abcdefghi") * 3,
    list("abcdefghi") * 2 + list("abcdefgh"), ["a"] * 30 + ["b"] * 30, (["a"] * 24 + ["b"]) * 4, (["a", "b"] * 12 + ["c"]) * 5])
def test_runs_at_the_limits(words):
    assert got(words) == brute(words)


def test_texts_of_one_chunk_do_not_touch():
    half = [b"a", b"b"] * 11
    assert pr._of_texts([half, half, [], half + half], [None] * 4, 24, 3) == [[], [], [], [(0, 44, 2)]]


def test_the_grammar_derives_its_text():
    rng = random.Random(2)
    x = np.array([rng.randint(0, 3) for _ in range(500)] + [-1] + [0, 1, 2] * 50 + [-2] + [3] * 77, np.int64)
    grammar = pr.Grammar(4)
    rest = pr.re_pair(x.copy(), grammar)

    def words(s):
        return [s] if s < 4 else words(grammar.left[s - 4]) + words(grammar.right[s - 4])
    assert [w for s in rest.tolist() for w in words(s)] == x.tolist()
    a, b = rest[:-1], rest[1:]
    pairs = [p for p in zip(a.tolist(), b.tolist()) if min(p) >= 0 and p[0] != p[1]]
    assert len(pairs) == len(set(pairs))


def test_awkward_rows_and_clashing_columns(spark, docs, empty):
    rows = pr.find_runs(docs).collect()
    assert len(rows) == docs.count() and pr.find_runs(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    for i in (4, 5, 6):
        assert by[i].n_words == 0 and by[i].runs == [] and by[i].collapsed == ""
    assert by[14].collapsed == "日本語 テキスト ß Σας" and by[11].n_words == 30_000 and by[None].runs == []
    text = "x " + "\tlala  la la\n" * 20
    one = pr.find_runs(spark.createDataFrame([("k", text, 3, "c")], "doc_id string, text string, runs int, collapsed string")).first()
    assert one.doc_id == "k" and [tuple(r) for r in one.runs] == [(1, 40, 2)] and one.collapsed == "x lala la la"


def test_limits_of_the_search_are_refused(docs):
    with pytest.raises(ValueError):
        pr.find_runs(docs, repeats=2)


def test_query_matches_brute_force(spark, sf):
    import duckdb
    rows = queries.op11_periodic_runs(spark, sf).collect()
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    by, runs_seen = {r.doc_id: r for r in rows}, 0
    for doc, text in texts:
        words, h = (text or "").encode().split(), zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words)
        if n > 4000:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want = [(s, e - s, q) for s, e, q in brute(words)]
        runs_seen += len(want)
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        r = by[doc]
        assert r.n_runs == len(want)
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{ln},{q}\n" for s, ln, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert runs_seen > 5
