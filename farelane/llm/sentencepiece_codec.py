"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the model holds a white-space marker after another character, so
merges never cross the start of a marked word.  A text is cut there; each
distinct marked word (its run of markers included) is segmented once per
Python worker, and a document's ids are the words' ids joined back by
position.  The table lives beside the text in the worker: sending every word
to a shared table and back would shuffle more than the text itself.

Defined results: NULL and empty text have no ids and decode to the empty
text; any text length works, a word of any length too; repeated rows give
repeated results; an empty table gives no rows; columns other than the id and
the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches, worker_cache

MARK = "▁"
#: Distinct words that a Python worker remembers, and the longest that it does.
CACHE_WORDS, CACHE_LENGTH = 500_000, 64
_RUNS = re.compile(" +[^ ]*")


def words_keep_markers_first(pieces: list[str]) -> bool:
    """Whether no piece has a marker behind another character, nor holds
    markers and other characters behind more than one marker."""
    return all(MARK not in p.lstrip(MARK) for p in pieces)


def marked_words(text: str) -> list[str]:
    """Marked words of a text, each without its first marker; markers are
    written as spaces.  Runs of markers go with the word behind them."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    return [w[1:] for w in _RUNS.findall(" " + text)]


def _encode(model_file: str, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        # a lone marker is a word without text, which the library would not see
        direct = not words_keep_markers_first(pieces) or MARK not in pieces
        table = worker_cache("sentencepiece_ids")
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            if direct:  # a model whose pieces span words: no table can be exact
                raws = [np.array(model.encode(t), dtype="<i4").tobytes() for t in texts]
            else:
                split = [marked_words(t) for t in texts]
                table[""] = np.array([model.piece_to_id(MARK)], dtype="<i4").tobytes()
                new = list({w for ws in split for w in ws if w not in table})
                for word, ids in zip(new, model.encode(new, num_threads=1)):
                    table[word] = np.array(ids, dtype="<i4").tobytes()
                raws = [b"".join(map(table.__getitem__, ws)) for ws in split]
                for word in new:
                    if len(word) > CACHE_LENGTH:
                        del table[word]
                if len(table) > CACHE_WORDS:
                    table.clear()
            offsets = np.zeros(len(raws) + 1, dtype=np.int32)
            np.cumsum([len(r) // 4 for r in raws], out=offsets[1:])
            flat = np.frombuffer(b"".join(raws), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])
    return run


def _decode(model_file: str, id_col: str, ids_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for batch in batches:
            ids = batch.column(ids_col)
            texts = [model.decode(x) if x else "" for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), ids, pa.array(texts, pa.string())],
                                             names=[id_col, ids_col, "decoded"])
    return run


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` of every row's whole text."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_encode(model_file, id_col, text_col), f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, ids, decoded`` of every row's whole ids (NULL ids: empty text)."""
    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(
        _decode(model_file, id_col, ids_col), f"`{id_col}` {kind}, `{ids_col}` array<int>, decoded string")
