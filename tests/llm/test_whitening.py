"""Whitening against numpy's own eigenvectors and exact integers."""
import math

import numpy as np
import pytest

from webfoot.llm import queries, whitening


def plain(rows, top=16, scale=64, shift=1_000_000):
    """``{vec_id: (n, deviation, whitened, explained)}`` for rows of one dimension, ids without repeats."""
    kept = [(i, [math.floor(scale * c) + shift for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, total)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
    good = values > 1e-11 * max(values[0], 1e-300)
    values, vectors = values[good], vectors[:, good]
    trace = (centred ** 2).sum() / n
    return {i: (n, sum((n * c - s) ** 2 for c, s in zip(x, total)),
                np.array([(n * c - s) / n for c, s in zip(x, total)]) @ vectors / np.sqrt(values), values / trace) for i, x in kept}


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def agree(got, want, tolerance=1e-8):
    assert set(got) == {i for i, w in want.items() if len(w[2])}
    signs = None
    for i, held in got.items():
        n, deviation, w, shares = want[i]
        assert sorted(held) == list(range(1, len(w) + 1))
        ours = np.array([held[c].whitened for c in sorted(held)])
        signs = np.ones(len(w)) if signs is None else signs
        for c, r in held.items():
            assert (r.n, r.deviation) == (n, deviation) and 0 <= r.identity_error <= 1e-4
            assert math.isclose(r.explained, shares[c - 1], rel_tol=1e-6)
        want[i] = (ours, w)
    ours, theirs = (np.array([want[i][j] for i in got]) for j in (0, 1))
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - signs * theirs).max() < tolerance * max(1.0, np.abs(theirs).max())


def test_query_against_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    df = queries.op12_whitening(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double")]
    agree(by_id(df), plain(rows))


def test_odd_rows_hot_copies_and_several_dimensions(spark):
    rng = np.random.default_rng(4)
    small = [(i, (rng.normal(size=5) * [9, 5, 3, 2, 1]).tolist()) for i in range(200)]
    small += [(200 + i, small[3][1]) for i in range(150)]  # one vector with a large share of the rows
    wide = [(1000 + i, (rng.normal(size=40) * np.geomspace(20, 1, 40)).tolist()) for i in range(300)]
    flat = [(2000 + i, [1.0, 2.0, 3.0]) for i in range(4)]  # no variance: no rows
    odd = [(3000, None), (3001, []), (3002, [1.0, None, 0.0, 0.0, 0.0]), (3003, [float("nan")] * 5), (3004, [float("inf")] * 5),
           (3005, [1e300] * 5), (None, small[0][1]), (7, small[9][1])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in small + wide + flat + odd], "vec_id long, embedding array<double>, n double")
    whole = whitening.whiten(df)
    agree(by_id(whole.where("vec_id between 1000 and 1999")), plain(wide))
    want = plain(small)
    repeated = [r for r in whole.where("vec_id = 7").collect()]
    assert len(repeated) == 10 and whole.where("vec_id is null").count() == 5 and whole.where("vec_id >= 2000").count() == 0
    agree(by_id(whole.where("vec_id < 1000 and vec_id <> 7")), {i: w for i, w in want.items() if i != 7})
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 1")).count() == 0


def test_exact_deviation_of_large_numbers(spark):
    rows = [(1, [3.0e9, 1.0]), (2, [1.0, 0.5]), (3, [2.0, -7.0]), (4, [-1.0, 3.25])]
    got = by_id(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = plain(rows)
    for i, held in got.items():
        exact = want[i][1]
        assert held[1].deviation == (exact if exact < 1 << 63 else None)
    assert any(w[1] >= 1 << 63 for w in want.values())


@pytest.mark.parametrize("values", [
    [5, 5, 5, 5, 2, 2, 1, 0], [1e6, 1, 1e-3, 1e-6], [3.0], [7, 7], list(range(40, 0, -1)),
    [1 + 1e-13 * i for i in range(20)], [10] * 17 + [1] * 30])
def test_leading_components(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
    v = (q * np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    found, vectors = whitening.leading_components(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    want = want[want > 1e-11 * want[0]]
    assert np.allclose(found, want, rtol=1e-9, atol=1e-14 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * found).max() < 1e-13 * len(values) * want[0]


def test_matrices_that_fall_apart():
    for v in (np.zeros((3, 3)), np.diag([4.0, 4.0, 1.0, 0.0]), np.kron(np.eye(3), [[2.0, 1.0], [1.0, 2.0]]), np.eye(20)):
        found, vectors = whitening.leading_components(v, 16)
        assert np.allclose(found, [x for x in np.linalg.eigvalsh(v)[::-1][:16] if x > 1e-11])
        assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-13
        assert np.abs(v @ vectors - vectors * found).max(initial=0) < 1e-13


def test_sturm_counts():
    rng = np.random.default_rng(8)
    d, e = rng.normal(size=30), rng.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-5, 5, 101)
    assert whitening.sturm_count(d, e, at).tolist() == [(values < x).sum() for x in at]
