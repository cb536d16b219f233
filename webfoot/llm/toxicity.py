"""Toxicity scores: Levenshtein automata intersected with a lexicon trie, and context windows.

Learning.  A bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each
class, smallest id hashes first; rows whose crc32(id) is 0 modulo 5 are never
learned from) gives the counts of words for either class.  Spark sums them.
Words far more frequent in toxic rows become the lexicon, and so do stems:
word beginnings that several different such words share.  An entry weighs the
logarithm of its ratio.  The lexicon has at most ``MAX_LEXICON`` entries.

Matching.  The entries form a trie.  A word meets an entry when it is within
the edit budget that the entry's length allows.  The Levenshtein automaton of
the word runs over the trie as sets of (node, errors); these sets are made
into a deterministic automaton on demand, so a word costs one table look-up
for each character and most words fail after three or four.  Words known from
clean rows never match by edits; all other spellings near an entry do.

Context.  Every hit is weighed by a window around it: inside quotation marks
it counts less, and less again beside a word of reporting; beside a second
person or another hit it counts more.  The sum, over ``PRIOR_HITS`` plus one
for every ``WORDS_PER_HIT`` words, goes through a logistic curve fitted to the
sample: one word quoted in a long clean text weighs little.

The scan is row-local and shuffles nothing; the sample's counts are the only
shuffle.  Labels are joined by broadcast, bounded by the sample size.

Defined cases: null and empty texts have no hits and get the curve's lowest
score; null labels and labels of unknown rows are not learned from; of
contradicting labels of an id the larger counts; without toxic or clean
examples the lexicon is empty and the default curve holds; a null id is never
held out; repeated rows are scored alike; an empty table gives an empty
result; columns with the name of an output column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webfoot.llm.common import append_columns, col, discard, filter_rows, lean, materialize, text_slices

SAMPLE_PER_CLASS = 6000
MAX_LEXICON = 2000
MIN_SUPPORT = 0.01  # of the toxic sample's documents
MIN_RATIO = 10.0  # rate among toxic words over rate among clean words
PURE_RATIO = 200.0  # an entry with this ratio weighs 1
CLEAN_PRIOR = 3.0  # occurrences added to the clean count
STEM_LENGTHS = (3, 4, 5, 6)
PER_DOCUMENT = 3  # occurrences of a word that count in one document
STEM_FORMS = 4  # different words under a stem
PRIOR_HITS, WORDS_PER_HIT = 2.0, 50.0
LONGEST_WORD = 40
WINDOW_CHARS = 64
DEFAULT_CURVE = (-4.0, 10.0)
MEMO = 50_000

#: Words of reporting and of address, in the languages of the texts.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes word words term terms sagte schrieb nannte wort "
    "zitat begriff dit écrit mot terme citation dijo escribió palabra término cita".split())
ADDRESS = frozenset("you your yours youre du dich dir dein deine tu toi te vous vos ton usted eres ti tú".split())
_OPEN, _CLOSE = "“«„‘‹", "”»“’›"

FIELDS = [
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("strength", T.DoubleType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType()), T.StructField("entry", T.StringType()),
        T.StructField("errors", T.IntegerType()), T.StructField("start", T.IntegerType()),
        T.StructField("weight", T.DoubleType())]))),
]
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True, order=True)
class Entry:
    text: str
    stem: bool = False
    weight: float = 1.0
    exact: bool = False

    @property
    def budget(self) -> int:
        """Edits that an entry of this length allows."""
        return 0 if self.stem or self.exact or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


class Automaton:
    """All entries' tries and edit automata as one deterministic automaton, made on demand."""

    def __init__(self, entries: list[Entry], max_states: int = 100_000):
        self.entries, self.max_states = entries, max_states
        self.children, self.word, self.stem, self.most = [{}], [None], [None], [0]
        for number, entry in enumerate(entries):
            node = 0
            for ch in entry.text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.children[node][ch]
            if entry.stem:
                self.stem[node] = number
            else:
                self.word[node] = number
        for entry in entries:  # the largest budget below each node
            node = 0
            for ch in entry.text:
                self.most[node] = max(self.most[node], entry.budget)
                node = self.children[node][ch]
            self.most[node] = max(self.most[node], entry.budget)
        self._reset()

    def _reset(self):
        self.numbers, self.sets, self.steps, self.ends, self.stems = {}, [], [], [], []
        self.dead = self._state({})
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With characters of an entry left out of the word."""
        todo = list(nodes.items())
        while todo:
            node, errors = todo.pop()
            for child in self.children[node].values():
                if errors + 1 <= self.most[child] and errors + 1 < nodes.get(child, 99):
                    nodes[child] = errors + 1
                    todo.append((child, errors + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.numbers:
            ends = [(e, self.word[n]) for n, e in nodes.items()
                    if self.word[n] is not None and e <= self.entries[self.word[n]].budget]
            stems = [self.stem[n] for n, e in nodes.items() if e == 0 and self.stem[n] is not None]
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.ends.append(min(ends, default=None))
            self.stems.append(min(stems, default=None))
        return self.numbers[key]

    def _step(self, state: int, ch: str) -> int:
        out: dict[int, int] = {}
        for node, errors in self.sets[state]:
            moves = [(c, errors + (k != ch)) for k, c in self.children[node].items()] + [(node, errors + 1)]
            for to, e in moves:
                if e <= self.most[to] and e < out.get(to, 99):
                    out[to] = e
        return self._state(self._closed(out))

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, errors): the whole word as an entry, else a stem it begins with, else the nearest entry."""
        if len(self.sets) > self.max_states:
            self._reset()
        state, steps, stems, dead, stem = self.start, self.steps, self.stems, self.dead, None
        for ch in word:
            to = steps[state].get(ch)
            if to is None:
                to = steps[state][ch] = self._step(state, ch)
            state = to
            if state == dead:
                break
            if stem is None:
                stem = stems[state]
        end = self.ends[state]
        if stem is not None and not (end and end[0] == 0):
            return stem, 0
        return (end[1], end[0]) if end else None


class Model:
    """Lexicon, curve, and the known words that match no entry by edits."""

    def __init__(self, entries=(), curve=DEFAULT_CURVE, known=()):
        self.entries, self.curve, self.known = list(entries), curve, frozenset(known)

    def score_of(self, strength: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, self.curve[0] + self.curve[1] * strength))))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.automaton, self.memo = model, Automaton(model.entries), {}

    def _match(self, word: str):
        if len(word) > LONGEST_WORD + 2:
            word = word[:LONGEST_WORD + 2]  # no entry is longer; only a stem can still match
        hit = self.automaton.match(word)
        return None if hit and hit[1] and word in self.model.known else hit

    def hits(self, lower: str, words: list[str]) -> list[tuple[str, str, int, int, float]]:
        """(word, entry, errors, start, weight) of each hit, weighed by its window."""
        memo, any_hit = self.memo, False
        for word in set(words):
            if word not in memo:
                if len(memo) > MEMO:
                    memo.clear()
                memo[word] = self._match(word)
            any_hit = memo[word] is not None or any_hit
        if not any_hit:
            return []
        found = []
        for m in _WORD.finditer(lower):
            if m[0] not in memo:  # the memo may have been emptied meanwhile
                memo[m[0]] = self._match(m[0])
            if hit := memo[m[0]]:
                found.append((m[0], self.model.entries[hit[0]], hit[1], m.start(), m.end()))
        out = []
        for i, (word, entry, errors, start, end) in enumerate(found):
            weight = entry.weight * (1.0, 0.6, 0.4)[errors]
            left, right = lower[max(0, start - WINDOW_CHARS):start], lower[end:end + WINDOW_CHARS]
            near = set(_WORD.findall(left)) | set(_WORD.findall(right))
            if _quoted(left, right):
                weight *= 0.25 if near & REPORTING else 0.5
            elif near & ADDRESS or any(abs(found[j][3] - start) <= WINDOW_CHARS
                                       for j in (i - 1, i + 1) if 0 <= j < len(found)):
                weight *= 1.25
            out.append((word, entry.text, errors, start, weight))
        return out

    def __call__(self, texts: list) -> list[list]:
        scores, predicted, strengths, hits = [], [], [], []
        for raw in texts:
            lower = (raw or b"").decode("utf-8", "replace").lower()
            words = _WORD.findall(lower)
            found = self.hits(lower, words)
            strength = sum(h[4] for h in found) / (PRIOR_HITS + len(words) / WORDS_PER_HIT)
            score = self.model.score_of(strength)
            strengths.append(strength)
            scores.append(score)
            predicted.append(int(score >= 0.5))
            hits.append([dict(zip(("word", "entry", "errors", "start", "weight"), h)) for h in found])
        return [scores, predicted, strengths, hits]


def _quoted(left: str, right: str) -> bool:
    """Inside quotation marks that open and close within the window."""
    if left.count('"') % 2 and '"' in right:
        return True
    opened = max(left.rfind(c) for c in _OPEN)
    closed = max(left.rfind(c) for c in _CLOSE if c not in _OPEN)
    return opened > closed and any(c in right for c in _CLOSE)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning_sample(labels: DataFrame, per_class: int) -> DataFrame:
    """``(id, toxic)``: at most ``per_class`` rows of either class, none held out."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    parts = [known.where(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
             for c in ("toxic = 1", "toxic = 0")]
    return parts[0].unionByName(parts[1]).select(F.col("doc_id").alias("_wf_id"), F.col("toxic").alias("_wf_toxic"))


def word_table(sample: DataFrame) -> DataFrame:
    """``(word, toxic, clean, docs)``: occurrences in either class, toxic documents with the word."""
    def count(batches):
        for batch, texts in text_slices(batches, 0):
            sums, docs = {0: Counter(), 1: Counter()}, Counter()
            for raw, toxic in zip(texts, batch.column(1).to_pylist()):
                words = [w for w in words_of((raw or b"").decode("utf-8", "replace")) if len(w) <= LONGEST_WORD]
                for word, n in Counter(words).items():
                    sums[toxic][word] += min(n, PER_DOCUMENT)
                    docs[word] += toxic
            words = sorted(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())] + [pa.array([c[w] for w in words], pa.int64())
                                                  for c in (sums[1], sums[0], docs)],
                names=["word", "toxic", "clean", "docs"])

    return (sample.select("text", "_wf_toxic").mapInArrow(lean(count), "word string, toxic long, clean long, docs long")
            .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "docs")]))


def lexicon(table: DataFrame, n_toxic_docs: int) -> list[Entry]:
    """Words and stems far more frequent among toxic words (at most ``MAX_LEXICON``)."""
    totals = table.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not totals["toxic"] or not totals["clean"]:
        return []
    ratio = (F.col("toxic") / totals["toxic"]) / ((F.col("clean") + CLEAN_PRIOR) / (totals["clean"] + CLEAN_PRIOR))
    support = max(3, math.ceil(MIN_SUPPORT * n_toxic_docs))
    strong = (F.col("docs") >= support) & (ratio >= MIN_RATIO)
    stems = (table.withColumn("n", F.explode(F.array(*[F.lit(n) for n in STEM_LENGTHS])))
             .where(F.length("word") >= F.col("n")).groupBy(F.expr("left(word, n)").alias("entry"))
             .agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "docs")],
                  F.sum((F.col("toxic") > 0).cast("int")).alias("forms"))
             .where(strong & (F.col("forms") >= STEM_FORMS))
             .select("entry", F.lit(True).alias("stem"), ratio.alias("ratio"), "toxic"))
    words = (table.where(strong & (F.length("word") >= 3))
             .select(F.col("word").alias("entry"), F.lit(False).alias("stem"), ratio.alias("ratio"), "toxic"))
    found = words.unionByName(stems).orderBy(F.desc("ratio"), "entry", "stem").limit(MAX_LEXICON).collect()
    # A stem whose toxic occurrences are nearly all those of one sharper entry below it goes; of what
    # is left, the shortest stem stands for the stems below it, and words below one stay if sharper.
    stems = {r["entry"]: r for r in found if r["stem"]}
    for r in found:
        for n in range(1, len(r["entry"]) + (not r["stem"])):
            above = stems.get(r["entry"][:n])
            if above and r["toxic"] >= 0.8 * above["toxic"] and r["ratio"] > above["ratio"]:
                del stems[r["entry"][:n]]
    roots = {s: r["ratio"] for s, r in stems.items() if not any(s[:n] in stems for n in range(1, len(s)))}
    out = []
    for r in found:
        root = next((roots[r["entry"][:n]] for n in range(1, len(r["entry"]) + 1) if r["entry"][:n] in roots), None)
        if r["entry"] in roots if r["stem"] else root is None or r["ratio"] >= 2 * root:
            out.append(Entry(r["entry"], r["stem"], min(1.0, math.log(r["ratio"]) / math.log(PURE_RATIO))))
    return sorted(out)


def clean_neighbours(table: DataFrame, entries: list[Entry]) -> list[str]:
    """Words of clean rows within the edit budget of an entry, unless over twice as frequent in toxic rows."""
    def near(batches):
        automaton = Automaton(entries)
        for batch in batches:
            words = [w for w in batch.column(0).to_pylist() if (hit := automaton.match(w)) and hit[1]]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    totals = table.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    rare = (F.col("toxic") <= F.col("clean")) | (
        F.col("toxic") / F.lit(max(totals["toxic"] or 0, 1)) <= 2 * F.col("clean") / F.lit(max(totals["clean"] or 0, 1)))
    found = table.where((F.col("clean") > 0) & rare).select("word").mapInArrow(lean(near), "word string").collect()
    return sorted(r["word"] for r in found)  # words of the bounded sample


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Lexicon and curve from a bounded sample of labelled rows."""
    sample = materialize(
        docs.select(col(id_col).alias("_wf_doc"), col(text_col).cast("string").alias("text")).join(
            F.broadcast(learning_sample(labels, per_class)), F.col("_wf_doc") == F.col("_wf_id"))
        .select("_wf_doc", "text", "_wf_toxic"), "toxic-sample")
    sizes = {r["_wf_toxic"]: r["n"] for r in sample.groupBy("_wf_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model()
    table = materialize(word_table(sample), "toxic-words")
    entries = lexicon(table, sizes[1])
    model = Model(entries, known=clean_neighbours(table, entries))
    model.curve = fit_curve([tuple(r) for r in append_columns(
        sample, "text", FIELDS, lambda: Scorer(model), ["_wf_doc", "_wf_toxic"])
        .select("_wf_doc", "_wf_toxic", "strength").collect()])  # bounded by the sample
    discard(sample, table)
    return model


def fit_curve(rows: list[tuple], ridge: float = 0.1) -> tuple[float, float]:
    """Logistic regression of the label on the strength (Newton steps, ridge on the slope)."""
    rows = sorted(rows, key=lambda r: (str(r[0]), r[1], r[2]))
    y, x = np.array([r[1] for r in rows], float), np.minimum([r[2] for r in rows], 3.0)
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge * np.array([1e-3, 1.0]) * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3 * ridge, ridge])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score``, ``predicted``, ``strength`` and ``hits``."""
    return append_columns(docs, text_col, FIELDS, lambda: Scorer(model), keep)


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that are not predicted toxic."""
    def make():
        scorer = Scorer(model)
        return lambda texts: [p == 0 for p in scorer(texts)[1]]
    return filter_rows(docs, text_col, make)
