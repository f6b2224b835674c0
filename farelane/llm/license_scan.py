"""License scans: an exact set-similarity join of text blocks and templates.

A text's words are cut into overlapping blocks, a new one every half block,
so that a passage of half a block or less lies whole in one.  A block has
BLOCK_WORDS words, or twice those of the longest template if that is more, so
every template fits.  A template is found in a block that holds at least
``threshold`` of its distinct words.  Templates of different labels that share
so many words (notices of related licenses) are twins: of twins in one block
those stay of which it holds the largest share.  Words are ordered by how many blocks of the whole corpus hold
them, rarest first, and three filters spare almost every comparison:

* prefix: with overlap ``o`` needed, one of a template's ``size - o + 1``
  rarest words must be among a block's ``size - o + 1`` rarest;
* length: a block with fewer than ``o`` words of templates cannot match;
* position: the words behind the first common one must suffice for ``o``.

What is left is counted exactly.  Only words of templates can overlap, so the
order and the index hold those alone; both grow with the templates, not with
the text, and travel to the text, which is never shuffled.

Besides, the fixed phrases of BASE_PHRASES are found wherever their words
stand one after another.

Defined results: NULL and empty text have no words, places or labels and
score 0.  One result row per input row, repeated rows too; an empty table
gives none.  Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_WORDS, THRESHOLD = 64, 0.8
BASE_PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
#: Notices of common licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("reserved", "All rights reserved."),
]
_FIND = re.compile(WORDS).findall


def words_of(text: str | None) -> list[str]:
    """Words of a text after lower-casing A-Z."""
    return _FIND((text or "").encode().lower().decode())  # bytes.lower() changes A-Z alone


def block_starts(n: int, block: int = BLOCK_WORDS) -> list[int]:
    """First words of the blocks of ``n`` words; together they hold all."""
    half = block // 2
    return list(range(0, max(1, n - half), half)) if n else []


def blocks_of(places: list[tuple[int, str]], n: int, block: int = BLOCK_WORDS) -> dict[int, set[str]]:
    """The chosen words of each block that holds any, by the block's start."""
    half, last = block // 2, (block_starts(n, block) or [0])[-1]
    out: dict[int, set[str]] = {}
    for i, w in places:
        for start in {min(i // half * half, last), max(0, i // half * half - half)}:
            if start <= i < start + block and start <= last:
                out.setdefault(start, set()).add(w)
    return out


def block_words(templates: list[tuple[str, str]], least: int = BLOCK_WORDS) -> int:
    """Words of a block, an even number: every template fits in half of one."""
    return max([least + least % 2, *(2 * len(words_of(t)) for _, t in templates)])


class Templates:
    """Templates with their words in the order ``rank`` (rarest first) and an
    index from prefix words to (template, position)."""

    def __init__(self, templates: list[tuple[str, str]], rank: dict[str, int], threshold: float):
        self.rank, self.labels, self.sets, self.need = rank, [], [], []
        self.index: dict[str, list[tuple[int, int]]] = {}
        for t, (label, text) in enumerate(templates):
            words = sorted(set(words_of(text)), key=lambda w: (rank.get(w, 0), w))
            need = math.ceil(threshold * len(words) - 1e-9)
            self.labels.append(label)
            self.sets.append(frozenset(words))
            self.need.append(need)
            for i, w in enumerate(words[:len(words) - need + 1]):
                self.index.setdefault(w, []).append((t, i))
        self.twins = [{u for u, other in enumerate(self.sets) if self.labels[u] != self.labels[t]
                       and len(own & other) >= math.ceil(threshold * max(len(own), len(other)) - 1e-9)} for t, own in enumerate(self.sets)]

    def found(self, block: set[str]) -> list[tuple[int, float]]:
        """Templates that the block holds, with their containment."""
        if self.index.keys().isdisjoint(block):
            return []
        words = sorted(block, key=lambda w: (self.rank.get(w, 0), w))
        tried, out = set(), []
        for j, w in enumerate(words):
            for t, i in self.index.get(w, ()):
                if t in tried or j > len(words) - self.need[t]:  # length and the block's own prefix
                    continue
                tried.add(t)
                if 1 + min(len(self.sets[t]) - i - 1, len(words) - j - 1) < self.need[t]:  # position
                    continue
                both = len(self.sets[t] & block)
                if both >= self.need[t]:
                    out.append((t, both / len(self.sets[t])))
        return [(t, c) for t, c in out if not any(u in self.twins[t] and d > c for u, d in out)]


def word_frequency(docs: DataFrame, templates: list[tuple[str, str]], text_col: str = "text", block: int = BLOCK_WORDS) -> dict[str, int]:
    """Blocks of the whole corpus that hold each word of the templates."""
    vocabulary = {w for _, t in templates for w in words_of(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(text_col).to_pylist():
                words = words_of(text)
                if not vocabulary.isdisjoint(words):
                    places = [(i, w) for i, w in enumerate(words) if w in vocabulary]
                    for held in blocks_of(places, len(words), block).values():
                        total.update(held)
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
    small_batches(docs.sparkSession)
    counts = docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in counts.collect()}  # a row per word of the templates


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", block: int | None = None) -> DataFrame:
    """Per row: n_words, the phrases' places (label, first word) and the found
    blocks (label, template, first word, containment)."""
    templates = TEMPLATES if templates is None else templates
    block = block_words(templates) if block is None else block
    freq = word_frequency(docs, templates, text_col, block)
    order = sorted({w for _, t in templates for w in words_of(t)}, key=lambda w: (freq.get(w, 0), w))
    index = Templates(templates, {w: i for i, w in enumerate(order)}, threshold)
    vocabulary = set(order)
    ends = {p[-1] for p in BASE_PHRASES}
    watched = vocabulary | ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, all_places, all_found = [], [], []
            for text in batch.column(text_col).to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                base, found = [], []
                if not watched.isdisjoint(words):
                    places = [(i, w) for i, w in enumerate(words) if w in watched]
                    for i, w in places:
                        if w in ends:
                            for phrase, label in BASE_PHRASES.items():
                                at = i - len(phrase) + 1
                                if at >= 0 and tuple(words[at:i + 1]) == phrase:
                                    base.append({"label": label, "first_word": at})
                    places = [p for p in places if p[1] in vocabulary]
                    for start, held in sorted(blocks_of(places, len(words), block).items()):
                        found += [{"label": index.labels[t], "template": t, "first_word": start, "containment": c}
                                  for t, c in index.found(held)]
                all_places.append(base)
                all_found.append(found)
            yield pa.RecordBatch.from_arrays([
                batch.column(id_col), pa.array(n_words, pa.int64()),
                pa.array(all_places, pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))),
                pa.array(all_found, pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                                                        ("containment", pa.float64())])))], names=[id_col, "n_words", "places", "found"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, places array<struct<label:string,first_word:long>>, "
             "found array<struct<label:string,template:int,first_word:long,containment:double>>")
