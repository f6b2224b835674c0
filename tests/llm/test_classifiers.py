import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import language_gru as G
from farelane.llm import quality_qda as Q
from farelane.llm import queries
from farelane.llm import toxicity_fm as T

HELD, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"  # a tenth of the larger one holds too few toxic rows


def auc(score, y):
    pos, neg = score[y == 1], score[y == 0]
    return (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()


@pytest.mark.parametrize("name,label,least,sf", [("op4_quality_classifier", "quality", 0.97, HELD), ("op9_toxicity", "toxic", 0.95, LARGER)])
def test_held_out_accuracy(spark, name, label, least, sf):
    got = queries.QUERIES[name](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    both = got.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert auc(both.score.to_numpy(), both[label].to_numpy()) >= least
    assert got.score.between(0, 1).all()


def test_language_held_out(spark):
    got = queries.QUERIES["op10_language_id"](spark, HELD).toPandas()
    docs = spark.read.parquet(f"{HELD}/documents.parquet").toPandas()
    both = got.merge(docs, on="doc_id")
    both = both[both.held_out & both.text.str.len().gt(20)]
    assert (both.lang_pred == both.lang).mean() >= 0.97


def test_awkward_documents_get_one_row_each(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (7, 0), (8, 0), (None, 1), (9, None), (9, 0)], "doc_id long, label int")
    x = Q.features(docs)
    model = Q.fit(x, labels, "label")
    for got in (Q.score(x, model), T.score(docs, T.fit(docs, labels, "label"))):
        rows = got.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert Q.score(Q.features(empty), model).count() == 0
    assert T.score(empty, T.fit(empty, labels, "label")).count() == 0


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in Q.score(Q.features(docs), Q.fit(Q.features(docs), none, "label")).collect()} == {0.5}
    assert max(r.score for r in T.score(docs, T.fit(docs, none, "label")).collect()) < 0.01


def test_discriminant_against_plain_densities():
    rng = np.random.default_rng(1)
    x = {c: rng.normal(c, 1 + c, (200, 3)) for c in (0, 1)}
    m = Q.discriminant([200, 200], [x[c].sum(0) for c in (0, 1)], [x[c].T @ x[c] for c in (0, 1)])
    cov = [np.cov(x[c].T, bias=True) for c in (0, 1)]
    pooled = np.diag(np.diag(cov[0] + cov[1]) / 2)
    p = rng.normal(0.5, 2, (20, 3))
    logs = []
    for c in (0, 1):
        s = (1 - Q.SHRINKAGE) * cov[c] + Q.SHRINKAGE * pooled
        d = p - x[c].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert np.allclose(m.score(p), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_machine_logits_against_all_pairs():
    rng = np.random.default_rng(2)
    m = T.Machine(0.3, np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)))
    rows = [[0, 3, 5], [], [8], [1, 2, 4, 7]]
    starts = np.cumsum([0] + [len(r) for r in rows])
    got = m.logits(np.array([i for r in rows for i in r]), starts)
    for r, g in zip(rows, got):
        want = 0.3 + sum(m.weights[i] for i in r) + sum(m.factors[a] @ m.factors[b] for i, a in enumerate(r) for b in r[:i])
        assert abs(g - want) < 1e-9


def test_machine_learns_a_pair_that_no_single_term_shows():
    rng = np.random.default_rng(4)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array([i for i, on in enumerate((a, b)) if on], dtype=np.int64))
        y.append(float(a and b))
    m = T.train(rows, np.array(y), np.arange(2))
    score = [m.scores(np.array(r), np.array([0, len(r)]))[0] for r in ([0], [1], [0, 1])]
    assert score[2] > 0.8 and max(score[:2]) < 0.3


def test_network_gradients():
    net = G.network(["a", "b", "c"])
    net.tables = [t.astype(np.float64) for t in net.tables]
    x = np.random.default_rng(0).integers(97, 100, (5, 3)).astype(np.uint8)
    y = np.array([0, 1, 2])
    _, grads = G.gradients(net, x, y)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep = p[at]
        p[at] = keep + 1e-2
        up = G.gradients(net, x, y)[0]
        p[at] = keep - 1e-2
        down = G.gradients(net, x, y)[0]
        p[at] = keep
        assert abs((up - down) / 2e-2 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_network_pools_every_byte():
    net = G.network(["a", "b"])
    raws = [b"", b"x" * 5, bytes(range(97, 123)) * 20, b"z" * G.WINDOW]
    got = G.pooled(net, raws)
    for i, raw in enumerate(raws):
        total = np.zeros(2)
        for lo in range(0, len(raw), G.WINDOW):
            part = raw[lo:lo + G.WINDOW]
            w = np.frombuffer(part.ljust(G.WINDOW), np.uint8).reshape(-1, 1)
            total += G.positions(net, w)[:len(part), :, 0].sum(axis=0)
        assert np.allclose(got[:, i], total / max(1, len(raw)), atol=1e-5)


def test_language_of_awkward_documents(docs, empty):
    train = docs.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") > 2, "bb").alias("lang"))
    net = G.fit(train)
    got = {r.doc_id: r for r in G.predict(docs, net).collect()}
    assert {got[i].lang_pred for i in (4, 5, 6)} == {"und"}
    assert {r.lang_pred for r in got.values()} <= {"und", "aa", "bb"}
    assert G.predict(docs, net).count() == docs.count() and G.predict(empty, net).count() == 0
    untrained = G.fit(train.where("false"))
    assert {r.lang_pred for r in G.predict(docs, untrained).collect()} == {"und"}
