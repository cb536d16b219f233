"""Repetition coverage: how much of a text lies inside repeated n-grams and lines.

Words are runs of bytes other than the six ASCII spaces.  Each text's words
become integers (equal words, equal integers), and numpy takes rolling hashes
of every window of ``n`` of them.  A window is duplicated when another window
of the text has the same words; hash hits are confirmed on the integers
themselves, so no collision counts.  Longer windows are looked at only where
a shorter one is duplicated, since a repeated long window has repeated short
ones.  All work is row-local: no shuffle at any size.

Defined cases: null text counts as empty (no words, ``kept`` false as too
short); nulls in other columns and repeated rows pass through unchanged; an
empty table gives an empty result; input columns named like an output column
are replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webfoot.llm.common import append_columns

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

#: Window length in words -> largest share of word characters inside duplicated windows.
NGRAM_LIMITS = {5: 0.20, 7: 0.18, 10: 0.15}
#: Largest share of word characters in lines that repeat an earlier line.
LINE_LIMIT = 0.20
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BASE_WINDOW = 5

FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("coverage", T.MapType(T.IntegerType(), T.DoubleType())),
    T.StructField("dup_line_share", T.DoubleType()), T.StructField("kept", T.BooleanType()),
]

_ODD = np.random.default_rng(7).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _window_hash(ids: np.ndarray, n: int, starts: np.ndarray | None) -> np.ndarray:
    """Hash of the ``n`` ids from each start (all starts when None)."""
    h = np.zeros(len(ids) - n + 1 if starts is None else len(starts), np.uint64)
    for k in range(n):
        part = ids[k:len(ids) - n + 1 + k] if starts is None else ids[starts + k]
        h += (part + np.uint64(k + 1)) * _ODD[k % 64]
        h ^= h >> np.uint64(29)
    return h


def duplicated_starts(ids: np.ndarray, n: int, among: np.ndarray | None = None) -> np.ndarray:
    """Starts of windows of ``n`` ids whose ids stand elsewhere in the text too."""
    if len(ids) < n + 1:
        return np.empty(0, np.int64)
    if among is not None:
        among = among[among <= len(ids) - n]
        if len(among) < 2:
            return np.empty(0, np.int64)
    h = _window_hash(ids, n, among)
    if among is None:
        s = np.sort(h)
        if not (s[1:] == s[:-1]).any():
            return np.empty(0, np.int64)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    at = order if among is None else among[order]
    left, right = at[:-1][same], at[1:][same]
    for k in range(n):  # confirm on the words themselves
        if (ids[left + k] != ids[right + k]).any():
            return _duplicated_exact(ids, n, at)
    flag = np.zeros(len(at), bool)
    flag[:-1] |= same
    flag[1:] |= same
    return np.sort(at[flag])


def _duplicated_exact(ids: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    rows = np.stack([ids[starts + k] for k in range(n)], axis=1)
    _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    return np.sort(starts[counts[inverse.reshape(-1)] > 1])


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the words inside any of the windows."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(raw: bytes | None, limits: dict[int, float] = NGRAM_LIMITS,
            line_limit: float = LINE_LIMIT) -> tuple:
    """The output fields for one text (UTF-8 bytes)."""
    raw = raw or b""
    words = raw.split()
    n_words = len(words)
    solid = raw.translate(None, SPACES)
    word_chars = _points(solid)
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))

    seen: set[bytes] = set()
    n_dup_lines = dup_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            n_dup_lines += 1
            dup_chars += _points(line.translate(None, SPACES))
        elif line.strip(SPACES):
            seen.add(line)

    lengths = sorted({BASE_WINDOW, *limits})
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint64, n_words)
    n_repeat, coverage, sizes, starts = 0, {}, None, None
    for n in lengths:
        starts = duplicated_starts(ids, n, starts)
        share = 0.0
        if len(starts):
            mask = covered(starts, n, n_words)
            if sizes is None:
                sizes = np.fromiter((_points(w) for w in words), np.int64, n_words)
            share = float(sizes[mask].sum() / word_chars)
            if n == BASE_WINDOW:
                n_repeat = int(mask.sum())
        coverage[n] = share
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    line_share = dup_chars / word_chars if word_chars else 0.0
    kept = not base_failed and line_share <= line_limit and all(
        coverage[n] <= most for n, most in limits.items())
    return (n_words, word_chars, n_symbols, n_dup_lines, n_repeat, base_failed,
            coverage, line_share, kept)


def _points(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace"))


def repetition(docs: DataFrame, text_col: str = "text", limits: dict[int, float] | None = None,
               line_limit: float = LINE_LIMIT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the fields of ``FIELDS`` for each text."""
    limits = dict(NGRAM_LIMITS if limits is None else limits)

    def make():
        def fn(texts):
            rows = [measure(t, limits, line_limit) for t in texts]
            cols = [list(c) for c in zip(*rows)]
            cols[6] = [list(m.items()) for m in cols[6]]
            return cols
        return fn

    return append_columns(docs, text_col, FIELDS, make, keep)
