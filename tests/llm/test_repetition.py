"""Repetition coverage against a plain per-document version."""
import re

from webfoot.llm import queries, repetition

SF = "/root/testdata/sf0.001"


def _plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    out = {}
    for n in (5, 7, 10):
        wins = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        seen = {}
        for w in wins:
            seen[w] = seen.get(w, 0) + 1
        inside = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(n)}
        out[n] = inside
    chars = sum(map(len, words))
    lines, dup, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if not re.search(r"[^\x20\x09-\x0D]", line):
            continue
        if line in lines:
            dup += 1
            dup_chars += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        lines.add(line)
    failed = len(words) < 10 or 100 * len(out[5]) > 20 * len(words)
    share = lambda n: sum(len(words[i]) for i in out[n]) / chars if chars else 0.0
    kept = (not failed and all(share(n) <= most for n, most in {5: 0.20, 7: 0.18, 10: 0.15}.items())
            and (dup_chars / chars if chars else 0) <= 0.20)
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(out[5]), failed, kept)


def test_query_against_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op9_repetition(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:] == _plain(docs[r.doc_id]), r.doc_id


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None, "x"), (2, "", None), (3, " \n\t ", "x"), (4, "a b c d e " * 2000, "x"), (5, long, "x"), (5, long, "x"),
            (6, "é ü " + "same line here\n" * 30, "x"), (7, "one\x85two\u00a0three " * 12, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, KEPT string")
    got = repetition.repetition(df).collect()
    assert len(got) == len(rows) and sum(c.lower() == "kept" for c in got[0].asDict()) == 1
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        assert (by[i].n_words, by[i].word_chars, by[i].n_symbols, by[i].n_dup_lines, by[i].n_repeat_words,
                by[i].base_failed, by[i].kept) == _plain(t), i
    assert by[5].kept and not by[4].kept and not by[6].kept and not by[1].kept
    assert repetition.repetition(df.limit(0)).count() == 0


def test_hash_collisions_do_not_count(monkeypatch):
    import numpy as np
    monkeypatch.setattr(repetition, "_window_hash", lambda ids, n, starts: np.zeros(
        len(ids) - n + 1 if starts is None else len(starts), np.uint64))
    text = b" ".join(b"w%d" % i for i in range(40)) + b" w0 w1 w2 w3 w4 w5"
    assert repetition.measure(text)[4] == len(_plain_words_inside(text.decode()))


def _plain_words_inside(text):
    words = text.split()
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    return {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
