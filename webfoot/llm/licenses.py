"""License scan: exact set-similarity join between text blocks and license templates.

A text's words are cut into overlapping blocks: for a template of ``m`` words,
blocks of ``2 m`` words that start at every multiple of ``m``, so that any run
of ``m + 1`` words lies whole in one of them.  A block meets a template when
it holds at least the share ``threshold`` of the template's distinct words.

The join is exact and avoids most blocks.  Spark counts, over all texts, how
often each template word occurs; that gives one global order, rarest first.

* prefix filter: a block that meets a template of ``s`` distinct words, of
  which ``need`` must be present, holds one of its ``s - need + 1`` rarest;
* length filter: the block has at least ``need`` distinct template words;
* positional filter: with its rarest shared word at place ``i`` of the
  template's order, at most ``s - i`` words can be shared.

What is left is counted exactly.  Counts are made with one row per template
word and task and summed by Spark; templates are a parameter (``MAX_TEMPLATES``
bounds them), so the order and the templates travel with the task.  The
second pass is row-local and shuffles nothing.

Fixed phrases are looked for beside that: every place where a phrase's words
stand consecutively.

Defined cases: null text counts as empty (no words, no labels, score 0, null
places); other columns pass through, nulls and repeated rows included; columns
with the name of an output column are replaced; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webfoot.llm.common import append_columns, col, text_slices

MAX_TEMPLATES = 1000
THRESHOLD = Fraction(4, 5)

#: Phrase -> label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Well-known notices of public licenses, as (label, text).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms "
              "of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("template", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("containment", T.DoubleType())]))),
]

#: A-Z to a-z; every other byte that is not a digit, a-z or part of a non-ASCII character to a space.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
               for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_TABLE).split()


def vocabulary(templates, phrases) -> list[bytes]:
    found = {w for _, text in templates for w in words_of(text.encode())}
    return sorted(found | {w for p in phrases for w in words_of(p.encode())})


def word_counts(docs: DataFrame, text_col: str, vocab: list[bytes]) -> dict[bytes, int]:
    """How often each word of ``vocab`` occurs over all texts (at most one row per word comes back)."""
    known = frozenset(vocab)

    def count(batches):
        total: Counter = Counter()
        for _, texts in text_slices(batches, 0):
            for t in texts:
                total.update(filter(known.__contains__, words_of(t)))
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k.decode() for k in keys], pa.string()), pa.array([total[k] for k in keys], pa.int64())],
            names=["word", "n"])

    rows = (docs.select(col(text_col).cast("string").alias("text"))
            .mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect())
    return {r["word"].encode(): r["n"] for r in rows}


class Index:
    """Templates and phrases under one global word order (rank 0: rarest)."""

    def __init__(self, counts: dict[bytes, int], templates, phrases, threshold: Fraction):
        vocab = vocabulary(templates, phrases)
        self.rank = {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (counts.get(w, 0), w)))}
        self.templates, self.prefix = [], {}
        for number, (label, text) in enumerate(templates):
            words = words_of(text.encode())
            ranks = sorted({self.rank[w] for w in words})
            need = math.ceil(threshold * len(ranks))
            if not ranks:
                continue
            self.templates.append((number, label, ranks, need, len(words)))
            for place, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefix.setdefault(r, []).append((len(self.templates) - 1, place))
        self.phrases = []
        for phrase, label in phrases.items():
            words = words_of(phrase.encode())
            anchor = min(range(len(words)), key=lambda i: self.rank[words[i]])
            self.phrases.append((words, anchor, label))
        self.rare = frozenset(w for w, r in self.rank.items() if r in self.prefix) | frozenset(
            words[a] for words, a, _ in self.phrases)

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(start, label) of every phrase place."""
        found = []
        for phrase, anchor, label in self.phrases:
            at = -1
            for _ in range(words.count(phrase[anchor])):
                at = words.index(phrase[anchor], at + 1)
                start = at - anchor
                if start >= 0 and words[start:start + len(phrase)] == phrase:
                    found.append((start, label))
        return found

    def blocks(self, words: list[bytes]) -> list[tuple[str, int, int, int, float]]:
        """(label, template, start, end, containment) of every block that meets a template."""
        held = [(i, self.rank[w]) for i, w in enumerate(words) if w in self.rank]
        candidates: dict[tuple[int, int], int] = {}
        for i, r in held:
            for t, place in self.prefix.get(r, ()):
                step = self.templates[t][4]
                for k in {i // step, max(i // step - 1, 0)}:
                    candidates[t, k] = min(candidates.get((t, k), place), place)
        found = []
        for (t, k), place in sorted(candidates.items()):
            number, label, ranks, need, step = self.templates[t]
            if len(ranks) - place < need:  # positional filter
                continue
            lo, hi = k * step, min((k + 2) * step, len(words))
            inside = {r for i, r in held[_first(held, lo):_first(held, hi)]}
            if len(inside) < need:  # length filter
                continue
            shared = len(inside.intersection(ranks))
            if shared >= need:
                found.append((label, number, lo, hi, shared / len(ranks)))
        return found


def _first(held: list[tuple[int, int]], position: int) -> int:
    return bisect_left(held, (position, -1))


def scan_text(raw: bytes | None, index: Index) -> tuple:
    """The output fields for one text."""
    words = words_of(raw)
    if index.rare.isdisjoint(words):
        return len(words), 0, None, None, "", "", 0.0, []
    places, blocks = index.places(words), index.blocks(words)
    base = sorted({label for _, label in places})
    labels = sorted({*base, *(b[0] for b in blocks)})
    score = 1.0 if places else max((b[4] for b in blocks), default=0.0)
    starts = [s for s, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(base), ",".join(labels), score,
            [dict(zip(("label", "template", "start", "end", "containment"), b)) for b in blocks])


def license_scan(docs: DataFrame, text_col: str = "text", templates=None, phrases=None,
                 threshold: Fraction = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the fields of ``FIELDS`` for each text."""
    templates = list(TEMPLATES if templates is None else templates)
    phrases = dict(PHRASES if phrases is None else phrases)
    if len(templates) > MAX_TEMPLATES or len(phrases) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates or phrases")
    counts = word_counts(docs, text_col, vocabulary(templates, phrases))

    def make():
        index = Index(counts, templates, phrases, threshold)

        def fn(texts):
            return [list(c) for c in zip(*(scan_text(t, index) for t in texts))]
        return fn

    return append_columns(docs, text_col, FIELDS, make, keep)
