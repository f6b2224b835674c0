import public_tokenizers
import sentencepiece

from farelane.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_and_text_equal_the_library(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in S.decode(S.encode(docs, PATH), PATH).collect():
        assert r.ids is not None
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in S.decode(S.encode(docs, PATH), PATH).collect():
        want = model.encode(texts[r.doc_id] or "")
        assert list(r.ids) == want
        assert r.decoded == model.decode(want)
    assert S.decode(S.encode(empty, PATH), PATH).count() == 0


def test_words_with_runs_and_marks(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["", " ", "  a", "a  ", "a   b\n\n c\t", "▁", "▁▁ x", "a▁b", " \n ", "<s> </s> <unk>", "��", "12 345  6", "é ﬁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.decode(S.encode(df, PATH), PATH).collect()}
    for i, t in enumerate(texts):
        assert list(got[i].ids) == model.encode(t), t
        assert got[i].decoded == model.decode(model.encode(t)), t


def test_a_model_whose_pieces_span_words_is_noticed():
    assert S.words_keep_markers_first(["▁a", "▁▁", "b"])
    assert not S.words_keep_markers_first(["a▁b"])
