"""Merkle manifest against a plain recomputation; layout, tampering, odd tables."""
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from webfoot.llm import merkle, queries
from webfoot.llm.common import lower_az

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """All levels of a tree over hex digests."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def plain(rows):
    """Rows of the query's result for rows in the order of ``FIELDS``."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {k: climb([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]) for k in names}
    top = climb([levels[k][-1][0] for k in names])
    root = top[-1][0]
    out = []
    for at, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            changed = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                changed = leaf((*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])))
            siblings, folded = [], changed
            for chain, place in ((levels[name], i), (top, at)):
                for level in chain[:-1]:
                    run = level[place // 8 * 8:place // 8 * 8 + 8]
                    siblings += run[:place % 8] + run[place % 8 + 1:]
                    folded = h(*run[:place % 8], folded, *run[place % 8 + 1:])
                    place //= 8
            out.append((row[0], own, levels[name][-1][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def proofs(df):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    held = merkle.manifest(df, FIELDS, changed={"text": lower_az(F.col("text"))}, where=tampered)
    return sorted(map(tuple, merkle.proofs(held).collect()), key=repr)


def test_query_against_plain_recomputation(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r[f] for f in FIELDS) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_merkle(spark, sf).collect()), key=repr) == plain(rows)


def test_odd_tables(spark):
    rows = [(i, "s", "de", i, f"Text {i} ABC") for i in range(530)]  # two blocks
    rows += [(i, None, "fr", None, None if i % 2 else "XYZ") for i in range(9)]
    rows += [(5, "s", None, 1, "a"), (7, "s", "", 1, ""), (3, "é|:-", "日本", 4, "ABC")]
    rows += [(None, "s", "nul", 1, "x"), (None, "s", "nul", 1, "A"), (2, "s", "nul", 1, "b"), (2, "s", "nul", 1, "b"), (2, "t", "nul", 1, "C")]
    rows += [(9000 + i, "s", f"lang{i}", 1, "C") for i in range(70)]  # a top tree of several levels
    assert proofs(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)
    one = [(1, "s", "de", 1, "ABC")]
    got = proofs(spark.createDataFrame(one, SCHEMA))
    assert got == plain(one) and got[0][4] == h()


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, "s", "x", 1, "t", "a", i, "b") for i in range(3)],
                               SCHEMA + ", tree string, position int, `a.b` string")
    assert proofs(df) == plain([(i, "s", "x", 1, "t") for i in range(3)])
    assert proofs(df.limit(0)) == []
    renamed = df.withColumnsRenamed({"doc_id": "size", "lang": "block", "text": "digest"})
    held = merkle.manifest(renamed, ["size", "source", "block", "n_chars", "digest"], "size", "block")
    assert sorted(r.folded_root == r.root for r in merkle.proofs(held).collect()) == [True] * 3


def test_three_steps_of_blocks(spark):
    n = merkle.ARITY ** (2 * merkle.BLOCK_LEVELS) + 1
    digest = lambda i: sha256(b"%d" % i).digest()
    leaves = spark.range(n).select(F.lit("=x").alias("tree"), F.lit(n).alias("size"), F.col("id").alias("position"),
                                   F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    forest = merkle.plant(leaves, "test")
    levels = climb([digest(i).hex() for i in range(n)])
    assert len(forest.steps) == 3
    assert [(r.tree, bytes(r.digest).hex()) for r in forest.roots.collect()] == [("=x", levels[-1][0])]
    paths = merkle.paths_above(forest, spark.createDataFrame([("=x", b"")], "tree string, path binary"))
    blocks = {r.block: r for r in forest.steps[0].join(paths, ["tree", "block"]).where("block in (0, 300, 511, 512)").collect()}
    for number, place in ((0, 0), (300, 77), (511, 511), (512, 0)):
        r = blocks[number]
        height = min(merkle.BLOCK_LEVELS, merkle.height_of(n))
        way = merkle.Block(height, r["count"], r.nodes).path(place, {}) + merkle.unpacked(r.path)
        i, want = number * 512 + place, []
        assert merkle.folded(digest(i), way) == levels[-1][0]
        for level in levels[:-1]:
            run = level[i // 8 * 8:i // 8 * 8 + 8]
            want.append(("".join(run[:i % 8]).encode(), "".join(run[i % 8 + 1:]).encode()))
            i //= 8
        assert way == want


@pytest.mark.parametrize("height", range(6))
def test_van_emde_boas_addresses(height):
    held = merkle.Layout(height)
    flat = np.concatenate(held.rows)
    assert sorted(flat.tolist()) == list(range(held.size)) and held.address(0, 0) == 0
    upper = (height + 1) // 2
    if upper:  # the upper half first, then each subtree below it in one piece
        top = np.concatenate(held.rows[:upper])
        assert sorted(top.tolist()) == list(range(held.nodes(upper)))
        for j in range(min(8 ** upper, 20)):
            under = np.concatenate([held.rows[upper + d][j * 8 ** d:(j + 1) * 8 ** d] for d in range(height + 1 - upper)])
            assert under.max() - under.min() + 1 == len(under) == held.nodes(height + 1 - upper)


def test_a_wrong_sibling_or_place_is_noticed():
    block = merkle.Block.build(2, [sha256(bytes([i])).digest() for i in range(13)])
    root, memo = block.get(0, 0).hex(), {}
    for i in range(13):
        way = block.path(i, memo)
        assert merkle.folded(sha256(bytes([i])).digest(), way) == root
        assert merkle.unpacked(merkle.packed(way)) == way
        assert merkle.folded(sha256(b"other").digest(), way) != root
        left, right = way[0]
        assert not (left or right) or merkle.folded(sha256(bytes([i])).digest(), [(right + left, b"")] + way[1:]) != root or not right
