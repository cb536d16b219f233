"""The pipeline against stage-by-stage brute force on a small table."""
import re
import zlib

import numpy as np

import corpus_pipeline
from webfoot.llm import queries

SF = "/root/testdata/sf0.001"


def _shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        held.append(corpus_pipeline.materialize(stage(spark, held[-1], SF), name))
    rows = [{r.doc_id: r for r in h.collect()} for h in held[:-1]]
    assert [h.columns for h in held[:-1]] == [docs.columns] * 5
    # toxicity: what the query predicts toxic goes, the rest is unchanged
    toxic = {r.doc_id for r in queries.op3_toxicity(spark, SF).collect() if r.predicted}
    assert rows[1] == {i: r for i, r in rows[0].items() if i not in toxic}
    # near-duplicates: one of each component stays
    sets = {i: _shingles(r.text) for i, r in rows[1].items()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = a, b
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
    assert rows[2] == {i: rows[1][i] for i in root if root[i] == i}
    # personal data: same rows, no entity left, clean texts unchanged
    assert rows[3].keys() == rows[2].keys()
    seen = re.compile(r"\S+@\S+\.\w+|\+1 \(\d+\) \d+-\d+|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b")
    for i, r in rows[3].items():
        assert not set(seen.findall(rows[2][i].text)) & set(seen.findall(r.text)) and r.n_chars == len(r.text)
        if not re.search(r"[0-9@]", rows[2][i].text):
            assert r == rows[2][i]
    # mixing: the same rows in another order
    assert rows[4] == rows[3]
    # packing: every id of every document once
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    pieces = {}
    for r in held[-1].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == rows[4].keys()
    for i, ps in pieces.items():
        ids = np.array(t.encode(rows[4][i].text, add_special_tokens=False).ids + [1], "<u4")
        assert sum(p.length for p in ps) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for p in ps)
    assert corpus_pipeline.run(spark, SF).count() == held[-1].count()


def test_empty_and_odd_documents(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x@y.example.com " * 20, None, "s", 320), (3, "x@y.example.com " * 20, None, "s", 320),
         (None, "null id", "en", None, 7)], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        held = table
        for name, stage in corpus_pipeline.STAGES:
            held = corpus_pipeline.materialize(stage(spark, held, SF), name)
        assert held.count() == (0 if table is not docs else held.count())
    assert {r.doc_id for r in held.collect()} == set()


def test_entry_registers_all():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in names)] == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
