"""Exact top-k against brute force in integers."""
import math

import numpy as np

from webfoot.llm import queries, topk

SF = "/root/testdata/sf0.001"


def _plain(rows, every, k=10):
    ints = set()
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints.add((i, tuple(math.floor(1024.0 * x) for x in v)))
    scored = {}
    for q, a in ints:
        if q % every == 0:
            scored.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q and len(a) == len(b))
    return {(q, r + 1, i, -s) for q, found in scored.items() for r, (s, i) in enumerate(sorted(found)[:k])}


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert set(map(tuple, queries.op4_top_k(spark, SF).collect())) == _plain(rows, 100)


def test_blocks_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * 10 ** rng.uniform(-2, 1)).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(60)] + [(360 + i, [1.0, 2.0, 3.0]) for i in range(5)]
    rows += [(400, None), (401, []), (402, [1.0, None] + [0.0] * 6), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
             (None, [1.0] * 8), (0, rows[0][1]), (10, [9.0] * 8), (405, [0.0] * 8), (410, [-1.5] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = topk.top_k(df, lambda i: i % 10 == 0).collect()
    assert set(map(tuple, got)) == _plain(rows, 10) and len(got) == len(set(got))
    assert topk.top_k(df.limit(0), lambda i: i % 10 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), lambda i: i % 10 == 0).count() == 0


def test_bounds_skip_work_but_no_result():
    rng = np.random.default_rng(3)
    directions = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    c = np.floor(1024 * (rng.normal(size=(5000, 32)) * np.geomspace(1, 0.01, 32)) @ directions * rng.pareto(2, (5000, 1)))
    q, ids = c[:40], np.arange(5000)
    rotation, lead = topk.rotations({32: c.T @ c})[32]
    assert lead < 8
    rows, names, scores = topk.best_of_block(ids[:40], q, ids, c, np.full(40, -np.inf), rotation, lead, 10)
    full = q @ c.T
    for i in range(40):
        want = sorted((-s, j) for j, s in enumerate(full[i]) if j != i)[:10]
        assert sorted((-s, j) for s, j in zip(scores[rows == i], names[rows == i])) == want


def test_large_components_stay_exact(spark):
    rows = [(0, [3.0e12, 1.0]), (1, [1.0, 0.5]), (2, [2.0, -7.0]), (3, [-1.0, 3.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert set(map(tuple, topk.top_k(df, lambda i: i == 0).collect())) == _plain(rows, 100)


def test_long_vectors_and_ids_with_several_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4097).tolist()) for i in range(2)] + [(i, rng.normal(size=3).tolist()) for i in (0, 0, 1, 1, 2, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = set(map(tuple, topk.top_k(df, lambda i: i < 2, k=3).collect()))
    assert got == {r for r in _plain(rows, 1, 3) if r[0] < 2}


def test_blocks_that_cannot_reach_a_floor_stay_behind(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 40)
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=6) * 2.0 ** (-(i % 40))).tolist()) for i in range(400)]
    moved, true = [], topk._search

    def watched(pairs, turned, k):
        moved.append(pairs.count())
        return true(pairs, turned, k)

    monkeypatch.setattr(topk, "_search", watched)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert set(map(tuple, topk.top_k(df, lambda i: i % 40 == 0).collect())) == _plain(rows, 40)
    assert moved[0] == 1 and 1 <= moved[1] < 6  # of some ten blocks
