"""License scan by an exact set-similarity join of text blocks with templates.

A block is any run of as many words as the template has.  A block matches when
at least ``threshold`` of the template's different words are in it.  Words are
ordered by the number of documents that have them, counted over all documents,
rarest first.  A match of at least ``need`` words must then contain one of the
template's first |T| - need + 1 words (prefix filter), so only blocks around
those words are looked at; a document with too few words is passed over (length
filter), and a block is given up when the words that may follow its first common
word can't reach ``need`` (position filter).  What remains is verified.

Templates are a fixed list; documents are never compared with each other.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.shared import documents, id_type

THRESHOLD = 0.8

# Phrases whose exact places are reported, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Sentences of published license notices, with their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file "
     "except in compliance with the license", "apache-2"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 "
     "international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license",
     "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international "
     "license", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", "bsd"),
    ("you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
)

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of UTF-8 text, A-Z in lower case; any other ASCII character parts them."""
    return text.translate(_WORD_BYTES).split()


@dataclass
class Template:
    label: str
    words: tuple[bytes, ...]
    exact: bool  # also reported by place
    need: int = 0
    order: dict[bytes, int] = field(default_factory=dict)  # rarest word first


def make_templates(threshold: float = THRESHOLD, phrases=PHRASES, notices=NOTICES) -> list[Template]:
    made = []
    for group, exact in ((phrases, True), (notices, False)):
        for phrase, label in group:
            words = tuple(words_of(phrase.encode()))
            # A hair less, so that 0.8 * 5 asks for 4.
            need = max(1, math.ceil(threshold * len(set(words)) - 1e-9))
            made.append(Template(label, words, exact, need))
    return made


def order_words(templates: list[Template], frequency: dict[bytes, int]) -> None:
    for template in templates:
        ranked = sorted(set(template.words), key=lambda w: (frequency.get(w, 0), w))
        template.order = {w: k for k, w in enumerate(ranked)}


def document_frequency(docs: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """word, n: how many documents have each word of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
            names=["word", "n"],
        )

    return (
        docs.select(F.col("text").cast("binary"))
        .mapInArrow(count, "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def matching_blocks(words: list[bytes], template: Template, places: list[int]) -> Iterator[tuple[int, float]]:
    """(start, containment) of the blocks around ``places`` that match the template.

    ``places`` are the ascending places of the template's prefix words.
    """
    width, order, need = len(template.words), template.order, template.need
    if len(words) < need:
        return
    last_start = max(0, len(words) - width)
    done = -1
    for place in places:
        for start in range(max(done + 1, place - width + 1), min(place, last_start) + 1):
            done = start
            common = {order[w] for w in words[start : start + width] if w in order}
            if not common:
                continue
            first = min(common)
            if 1 + min(len(order) - first - 1, len(common) - 1) < need:
                continue
            yield start, len(common) / len(order)


def scan(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """doc_id, n_words, matches for ``docs`` (doc_id, text).

    A match is (label, exact, start, words, containment): places of exact phrases
    and the blocks that reach the threshold, a run of overlapping blocks of one
    template as its best block.
    """
    prefix: dict[bytes, list[int]] = defaultdict(list)
    for k, template in enumerate(templates):
        for word, rank in template.order.items():
            if rank <= len(template.order) - template.need:
                prefix[word].append(k)
    prefix = dict(prefix)

    def find(text: bytes) -> tuple[int, list[tuple]]:
        words = words_of(text)
        near: dict[int, list[int]] = defaultdict(list)
        if not prefix.keys().isdisjoint(words):
            for i, word in enumerate(words):
                for k in prefix.get(word, ()):
                    near[k].append(i)
        matches = []
        for k, places in near.items():
            template = templates[k]
            width = len(template.words)
            best: tuple | None = None
            for start, share in matching_blocks(words, template, places):
                if template.exact and tuple(words[start : start + width]) == template.words:
                    matches.append((template.label, True, start, width, 1.0))
                if best is not None and start < best[2] + width:
                    if share > best[4]:
                        best = (template.label, False, start, width, share)
                    continue
                if best is not None:
                    matches.append(best)
                best = (template.label, False, start, width, share)
            if best is not None:
                matches.append(best)
        return len(words), matches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("exact", pa.bool_()), ("start", pa.int64()),
            ("words", pa.int32()), ("containment", pa.float64()),
        ]))
        keys = ("label", "exact", "start", "words", "containment")
        for batch in batches:
            found = [find(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([[dict(zip(keys, m)) for m in ms] for _, ms in found], kind),
                ],
                names=["doc_id", "n_words", "matches"],
            )

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run,
        f"doc_id {id_type(docs)}, n_words long, matches array<struct<label:string,"
        "exact:boolean,start:long,words:int,containment:double>>",
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    phrases=PHRASES,
    notices=NOTICES,
) -> DataFrame:
    """doc_id, n_words, matches for every row of ``docs``; see ``scan``.

    Null text has no words and no match.  Rows that repeat are each scanned.  An
    empty table gives an empty result; other columns are ignored.
    """
    mine = documents(docs, id_col, text_col)
    templates = make_templates(threshold, phrases, notices)
    vocabulary = frozenset(w for t in templates for w in t.words)
    frequency = {bytes(r["word"]): r["n"] for r in document_frequency(mine, vocabulary).collect()}
    order_words(templates, frequency)
    return scan(mine, templates)
