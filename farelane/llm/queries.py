"""Registered queries of the operators: each applies one operator, with its
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import scratch_path

from . import (fingerprints, language_gru, license_scan, line_dedup, ngram_join, oracle, packing, periodic_runs, quality_qda,
               sentencepiece_codec, topk_nra, toxicity_fm, vector_codes, warc_bundles)
from .common import saved, table

#: A document is kept from this quality on, and dropped from this toxicity on.
QUALITY_KEPT, TOXICITY_DROPPED = 0.7, 0.3
WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary file lies on this and every node."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE)))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"), percent=90, width=3)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file(PIECE_BPE)
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def remainder(modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality_qda.features(table(spark, sf_dir, "documents"))
    model = quality_qda.fit(x, table(spark, sf_dir, "labels").where(remainder(4) != 2), "quality")
    return judged(quality_qda.score(x, model), QUALITY_KEPT)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan.scan(table(spark, sf_dir, "documents"))
    starts, base = F.col("places.first_word"), F.col("places.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.greatest(F.coalesce(F.array_max("found.containment"), F.lit(0.0)), F.when(F.size("places") > 0, 1.0).otherwise(0.0))
    return got.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                      F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
                      joined(F.concat(base, "found.label")).alias("labels"), best.alias("score"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fingerprints.edited(fingerprints.with_next(table(spark, sf_dir, "documents")))
    both = fingerprints.with_fingerprint(both, "edited", "edited_fingerprint")
    written = lambda c: F.array_join(c, " ")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written("fingerprint").alias("fingerprint"),
                       written("edited_fingerprint").alias("edited_fingerprint"),
                       fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity_fm.fit(docs, table(spark, sf_dir, "labels").where(remainder(4) != 2), "toxic")
    return judged(toxicity_fm.score(docs, machine), TOXICITY_DROPPED)


def judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_gru.fit(docs.where(remainder(5) != 0))
    return language_gru.predict(docs, net).select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def looped(doc_id: int | None, words: int):
    """The contract's order of a text's words: of every tenth document, by its
    id, those from one place on repeat a first stretch."""
    import zlib

    import numpy as np
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return None
    g = h // 10
    a = g % words
    order = np.arange(words)
    order[a:] = a + (order[a:] - a) % (1 + (words - a) // (3 + g % 8))
    return order


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), order=looped)
    written = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    # greatest exact length / period, then smallest start and period: cross products decide
    more = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    before = lambda x, y: (more(x, y) > 0) | ((more(x, y) == 0) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    best = F.when(F.size("runs") > 0, F.reduce(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                                               lambda x, y: F.when(before(y, x), y).otherwise(x)))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.try_divide(1000 * F.col("best.length"), F.col("best.period"))).alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    index = warc_bundles.write_bundles(warc_bundles.classify(pages), folder)
    records = saved(warc_bundles.read_bundles(index, folder).drop("payload"), "records")
    if not warc_bundles.broken_revisits(records).isEmpty():
        raise RuntimeError("a revisit record does not find its response")
    key = lambda c: warc_bundles.row_key(c, pages.schema["page_id"].dataType.simpleString())
    return records.select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    # few rows a label: sums are partial, and only they meet the codes again
    total = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (coded.join(total, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_ngram_jaccard_join, op3_sentencepiece, op4_quality_classifier, op5_line_dedup, op6_license_scan,
        op7_exact_topk, op8_document_fingerprints, op9_toxicity, op10_language_id, op11_periodic_runs,
        op12_warc_bundles, op13_vector_codes)
}

#: DuckDB SQL where SQL can express the result.
ORACLE: dict[str, str] = {
    "op2_ngram_jaccard_join": oracle.NGRAM_JOIN,
    "op6_license_scan": oracle.license_scan(license_scan.TEMPLATES, license_scan.block_words(license_scan.TEMPLATES), str(license_scan.THRESHOLD)),
    "op7_exact_topk": oracle.TOP_K,
    "op12_warc_bundles": oracle.WARC,
    "op13_vector_codes": oracle.VECTOR_CODES,
}
