import random

from pyspark.sql import functions as F

from farelane.llm import fingerprints as P
from farelane.llm import queries


def test_next_and_edit_against_a_plain_loop(spark, docs, empty):
    for groups_of in (4000, 2):
        P.GROUP_ROWS, keep = groups_of, P.GROUP_ROWS
        try:
            rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
            got = P.edited(P.with_next(docs)).collect()
        finally:
            P.GROUP_ROWS = keep
        want = []
        for i, (doc, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            m = len(text) // 4
            want.append((str(doc), text, after, text[:len(text) - m] + after[:m], len(text)))
        # repeated rows follow each other, so only the last one's next differs
        assert sorted((str(r.doc_id), r.text, r.next_text, r.edited, r.n_chars) for r in got) == sorted(want)
    assert P.with_next(empty).count() == 0


def test_one_document_follows_itself(spark):
    r = P.edited(P.with_next(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string"))).first()
    assert (r.next_text, r.edited) == ("abcdefgh", "abcdefab")


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 20) for _ in range(300))
    df = spark.createDataFrame([(text,)], "text string")
    r = P.with_positions(P.with_fingerprint(df, "text", "fp"), "text", "at").first()
    tokens = [w[i:i + P.TOKEN_CHARS] for w in text.split() for i in range(0, len(w), P.TOKEN_CHARS)]
    one = dict(spark.createDataFrame([(t,) for t in set(tokens)], "t string").select("t", F.xxhash64("t")).collect())
    pairs = {(a, b) for a, b in zip(tokens, tokens[1:])}
    two = {(x.a, x.b): x.h for x in spark.createDataFrame([(a, b, one[a], one[b]) for a, b in pairs], "a string, b string, x long, y long")
           .select("a", "b", F.xxhash64("x", "y").alias("h")).collect()}
    h = [two[p] for p in zip(tokens, tokens[1:])]
    chosen = [i for i in range(len(h) - 4) if min(h[i:i + 5]) in (h[i], h[i + 4])]
    assert [x.position for x in r["at"]] == chosen
    assert list(dict.fromkeys(x.anchor for x in r["at"])) == r.fp
    assert 0.25 < len(chosen) / len(h) < 0.6


def test_a_passage_keeps_its_anchors_in_any_context(spark):
    rng = random.Random(6)
    passage = " ".join(f"w{rng.randrange(999)}" for _ in range(60))
    df = spark.createDataFrame([(passage,), ("before it all " + passage + " and after",), ("",), ("one two",)], "text string")
    fp = [set(r.fp) for r in P.with_fingerprint(df, "text", "fp").collect()]
    assert fp[0] <= fp[1] and fp[2] == set() and len(fp[3]) == 1


def test_query_on_awkward_ids(spark, sf):
    got = queries.QUERIES["op8_document_fingerprints"](spark, sf).toPandas()
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    by_text = {}
    for r in got.itertuples():
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    long = got[got.n_chars > 200]
    assert (long.near_edited - long.near_next).quantile(0.05) > 0.2


def test_no_python_in_the_plan(spark, sf, capsys):
    queries.QUERIES["op8_document_fingerprints"](spark, sf).explain("formatted")
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


def test_groups_of_ids(spark):
    bounds = sorted(random.Random(1).sample(range(1000), 50))
    df = spark.range(1000).select("id", P._group(F.col("id"), bounds).alias("g"))
    assert all(r.g == sum(b <= r.id for b in bounds) for r in df.collect())


def test_a_text_with_a_token_has_an_anchor(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 5))) for _ in range(n)) for n in range(1, 12) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = P.with_positions(P.with_fingerprint(df, "text", "fp"), "text", "at").collect()
    assert all(r.fp and list(dict.fromkeys(x.anchor for x in r["at"])) == r.fp for r in rows)
    assert all(0 <= x.position <= max(0, len(r.text.split()) - P.TOKENS) for r in rows for x in r["at"])
    both = spark.createDataFrame([(a, b) for a, b in zip(texts[300:480:2], texts[301:480:2])], "a string, b string")
    both = P.with_fingerprint(P.with_fingerprint(both, "a", "fa"), "b", "fb").where("a <> b")
    assert both.where(P.likeness(F.col("fa"), F.col("fb")) == 1).isEmpty()
