import numpy as np
from pyspark.sql import functions as F

from farelane.llm import topk_nra as K


def brute(rows, k=10, every=100):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            x = [int(np.floor(1024 * float(np.float32(c)))) for c in v]
            usable[i] = min(usable.get(i, x), x)
    d = max(map(len, usable.values()), default=0)
    m = {i: np.array(x + [0] * (d - len(x)), dtype=object) for i, x in usable.items()}
    out = []
    for q in sorted(m):
        if q % every == 0:
            best = sorted(((-int(sum(m[q] * m[c])), c) for c in m if c != q))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return out


def run(spark, rows, k=10, every=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, c int")
    got = K.top_k(df, F.col("vec_id") % every == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def wide(rows):
    return [(i, None if v is None else [None if x is None else float(x) for x in v], "clash", 1) for i, v in rows]


def test_against_all_inner_products(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 90)
    monkeypatch.setattr(K, "QUERY_ROWS", 3)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16)) for i in range(700)]
    same = rng.normal(size=16)
    rows += [(1000 + i, same) for i in range(300)]  # a common vector: ties everywhere
    assert run(spark, wide(rows)) == brute(rows)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, -2.0]), (100, [0.0, 0.0]), (200, [float("nan"), 1.0]), (300, None), (400, [None, 1.0]), (500, []),
            (600, [float("inf"), 0.0]), (None, [1.0, 1.0]), (1, [1.0, -2.0]), (1, [0.5, 0.5]), (2, [3.0]), (3, [1.0, 1.0, 1.0])]
    assert run(spark, wide(rows)) == brute(rows)
    assert run(spark, wide(rows), k=2) == brute(rows, 2)
    assert run(spark, wide([(0, [1.0])])) == []
    assert run(spark, wide([(7, [1.0]), (8, [2.0])])) == []  # no query
    assert run(spark, wide([])) == []


def test_reading_stops_early_on_skewed_lists():
    rng = np.random.default_rng(1)
    rows = np.floor(1024 * rng.normal(size=(2000, 8)) * np.array([8, 4, 2, 1, .5, .2, .1, .1])).astype(np.int64)
    lists = K.SortedLists(np.arange(2000), rows)
    for q in range(0, 2000, 199):
        ids, scores = lists.top(rows[q], q, 10)
        every = rows @ rows[q]
        order = [i for i in np.lexsort((np.arange(2000), -every)) if i != q][:10]
        assert ids.tolist() == order and scores.tolist() == every[order].tolist()


def test_a_candidate_block_reaches_a_task_once_for_a_group(spark, monkeypatch):
    """A block used to come along with every query block that met it, in
    batches of thousands of rows: what a task held grew with the queries."""
    monkeypatch.setattr(K, "BLOCK_ROWS", 500)
    monkeypatch.setattr(K, "QUERY_ROWS", 10)
    seen, bytes_in = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    plain = K._meet

    def counted(*args):
        inner = plain(*args)

        def run(batches):
            def look():
                for batch in batches:
                    seen.add(max(0, batch.num_rows - 8))
                    bytes_in.add(batch.nbytes)
                    yield batch
            return inner(look())
        return run
    monkeypatch.setattr(K, "_meet", counted)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16)) for i in range(2000)]
    assert run(spark, wide(rows), every=2) == brute(rows, every=2)
    assert seen.value == 0
    # 100 query blocks meet 4 blocks of 500 rows: 64 KB each as 64-bit numbers, with their ids 68
    assert bytes_in.value < 100 * 4 * 68_000 / 4
