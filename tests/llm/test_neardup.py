"""Near-duplicates against all pairs."""
import random
from itertools import combinations

import numpy as np

from webfoot.llm import neardup, queries

SF = "/root/testdata/sf0.001"


def _sets(docs, k):
    out = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def _components(docs, k):
    sets = _sets(docs, k)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i][0]), find(i)) for i in sets}


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = _components(docs, 4)
    got = queries.op5_near_duplicates(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def _family():
    """Copies, near copies, chains and unrelated texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs, n = [], 0
    for length in (3, 30, 100, 300):
        base = [word() for _ in range(length)]
        for edit in (0, 0, 1, 1, 2, 4, 8):
            w = list(base)
            for _ in range(edit):
                w[rng.randrange(len(w))] = word()
            docs.append((n, " ".join(w)))
            n += 1
    chain = [word() for _ in range(200)]
    for step in range(12):  # neighbours are similar, the ends are not
        docs.append((n, " ".join(chain[step * 6:step * 6 + 120])))
        n += 1
    return docs


def test_families_and_chains(spark):
    docs = _family()
    for k in (4, 5):
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k=k).collect()}
        assert got == _components(docs, k)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "A b c d e f"), (8, "a B c d e f"),
            (9, "w " * 30_000), (10, "w " * 30_000 + "v"), (11, "École a b c d"), (12, "école a b c d"),
            (7, "A b c d e f"), (13, "p q r s t"), (13, "u v w x y"), (14, "u v w x y"), (15, "p q r s t"),
            (20, "k l m n o"), (20, "l m n o p"), (20, "z y x w v"), (21, "l m n o p"), (22, "z y x w v")]
    df = spark.createDataFrame([d + ("x",) for d in docs] + [(None, "A b c d e f", "x"), (None, None, None)],
                               "doc_id long, text string, kept string")
    rows = neardup.near_duplicates(df, k=4).collect()
    assert len(rows) == len(docs) + 2
    got = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    want = _components(docs, 4)
    assert got == {i: c for i, (_, c) in want.items()}
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    left = neardup.one_of_each(df, k=4)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()}) and ids.count(None) == 2
    assert neardup.near_duplicates(df.limit(0)).count() == 0 and neardup.one_of_each(df.limit(0)).count() == 0


def test_open_links_finds_what_pivots_leave(spark, monkeypatch):
    """Two similar pairs in one bucket of which the pivot is similar to neither."""
    shingle, rng = neardup.Shingler(4), random.Random(3)
    texts = {}
    for pair in range(3):
        base = [f"t{pair}x{rng.randrange(999)}" for _ in range(120)]
        texts[2 * pair] = " ".join(base)
        texts[2 * pair + 1] = " ".join(base[:-2] + ["z", "y"])
    reps = spark.createDataFrame(
        [(i, len(s), neardup.odd_sketch(s)[0].tolist(), neardup.odd_sketch(s)[1]) for i, t in texts.items()
         for s in [shingle(t.encode())]], "rep long, n long, sketch array<long>, filled long")
    keys = spark.createDataFrame([(7, i) for i in texts], "key long, rep long")
    roots = spark.createDataFrame([(1, 0)], "node long, root long")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for block in (2048, 2):
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = neardup.open_links(keys, reps, roots, docs, "doc_id", "text", 4, 80).collect()
        assert sorted(map(tuple, got)) == [(2, 3), (4, 5)]


def test_components_of_long_chains(spark):
    n = 70
    links = [(i, i + 1) for i in range(n)] + [(200, 201), (203, 201), (200, 201)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 201: 200, 203: 200}


def test_sketch_filter_keeps_similar_sets():
    rng = np.random.default_rng(1)
    for n in (20, 40, 150, 400, 700, 1500, 3000, 20000):
        for similarity in (0.8, 0.9, 0.97):
            shared = -int(-n * 2 * similarity // (1 + similarity))
            for _ in range(40):
                pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
                a, b = pool[:n], np.concatenate([pool[:shared], pool[n:2 * n - shared]])
                (x, f), (y, g) = (neardup.odd_sketch(np.unique(v)) for v in (a, b))
                z = int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())
                assert z <= neardup.most_differing_bits(f + g, 0.8 - neardup.MARGIN, np.exp), (n, similarity)
        for _ in range(20):  # and drops what is clearly less similar
            shared = int(n * 2 * 0.6 / 1.6)
            pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
            (x, f), (y, g) = (neardup.odd_sketch(np.unique(v)) for v in (
                pool[:n], np.concatenate([pool[:shared], pool[n:2 * n - shared]])))
            z = int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())
            assert n < 100 or z > neardup.most_differing_bits(f + g, 0.8 - neardup.MARGIN, np.exp), n


def test_both_filters_agree(spark):
    """The filter of the joins and that of the blocks is the same formula."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(float(f),) for f in (2, 80, 799, 800, 801, 1500, 2048)], "f double")
    for r in df.select("f", neardup.most_differing_bits(F.col("f"), 0.76, F.exp).alias("z")).collect():
        assert abs(r.z - neardup.most_differing_bits(r.f, 0.76, np.exp)) < 1e-9


def _bucket_rows(blocks):
    """Members of three buckets that overlap, as ``open_links`` deals them, and the pairs to find."""
    shingle, rng = neardup.Shingler(4), random.Random(11)
    base = [f"w{rng.randrange(10_000)}" for _ in range(150)]
    texts = [" ".join(base[:150 - 2 * i]) for i in range(4)] + [
        " ".join(f"u{i}x{rng.randrange(10_000)}" for _ in range(150)) for i in range(4)]
    keys = {r: sorted({5} | ({7} if r != 6 else set()) | ({9} if r % 2 else set())) for r in range(len(texts))}
    rows, sets = [], [shingle(t.encode()) for t in texts]
    for r, s in enumerate(sets):
        sketch, filled = neardup.odd_sketch(s)
        for key in keys[r]:
            block = r % blocks
            for other in range(blocks):
                rows.append(dict(key=key, i=min(block, other), j=max(block, other), block=block, rep=r,
                                 root=2 if r == 3 else r, n=len(s), filled=filled, keys=keys[r], sketch=sketch.tolist()))
    rows.sort(key=lambda r: (r["key"], r["i"], r["j"], r["block"]))
    want = sorted((a, b) for a, b in combinations(range(len(texts)), 2)
                  if (a, b) != (2, 3) and neardup.similar(sets[a], sets[b], 80))
    return rows, want


def test_a_pair_in_several_buckets_is_compared_once():
    """Across batches that cut the groups anywhere; before, each bucket had the pair and its full sets again."""
    import pyarrow as pa
    for blocks in (1, 3):
        rows, want = _bucket_rows(blocks)
        whole = pa.Table.from_pylist(rows)
        for size in (1, 5, 1000):
            got = []
            for table in neardup.whole_groups(iter(whole.to_batches(max_chunksize=size))):
                rep = table["rep"].to_pylist()
                got += [tuple(sorted((rep[x], rep[y]))) for pairs in neardup.promising_pairs(table, 80) for x, y in pairs]
            assert sorted(got) == want and len(want) >= 5


def test_buckets_are_not_taken_one_by_one(spark):
    """A call of Python for every small bucket took most of the time."""
    docs = spark.createDataFrame([(0, "a"), (1, "b")], "doc_id long, text string")
    reps = neardup.signatures(docs, "doc_id", "text", 4).withColumnRenamed("doc_id", "rep")
    keys = spark.createDataFrame([(7, 0), (7, 1)], "key long, rep long")
    roots = spark.createDataFrame([(1, 1)], "node long, root long")
    plan = neardup.open_links(keys, reps, roots, docs, "doc_id", "text", 4, 80)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
