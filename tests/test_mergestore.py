"""Merge-on-read store: newest rows, bytes written, moved sides, stops between writes."""
import os

from pyspark.sql import functions as F

from webfoot.operators import store as S
from webfoot.operators.mergestore import MergeStore


def rows(spark, n, first=0, seq=0, name="url"):
    return spark.range(first, first + n).select(
        F.lit(name).alias("store"), F.md5(F.col("id").cast("string")).alias("key_md5"), F.col("id").cast("string").alias("key"),
        F.concat(F.lit(f"v{seq}-"), F.col("id")).alias("value"), (F.col("id") % 10 + seq).alias("seq"))


def held(df):
    return sorted(map(tuple, df.select("store", "key_md5", "key", "value", "seq").collect()))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)


def moved_base(df):
    """The exchanges between the base's scan and its join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth, found = len(lines[at]), []
    margin = lambda line: len(line) - len(line.lstrip(" :+-"))
    depth = margin(lines[at])
    for line in reversed(lines[:at]):
        if margin(line) < depth:
            depth = margin(line)
            if "Join" in line:
                return found
            found += [line] * ("Exchange" in line)
    raise AssertionError("no join above the base")


def test_rows_bytes_and_moves(spark, tmp_path):
    path = str(tmp_path / "s")
    store, plain = MergeStore(spark, path), None
    assert store.read().count() == 0 and store.version == -1
    for step, batch in enumerate([rows(spark, 20_000), rows(spark, 50, 19_980, 100), rows(spark, 40, 0, 3),
                                  rows(spark, 30, 10, -50).unionByName(rows(spark, 5, 0, 7, "dns"))]):
        before = size(path) if step else 0
        store.upsert(batch)
        plain = S.upsert(plain, batch)
        if step == 0:
            store.compact()
            whole = size(path + "/base-0")
        else:
            assert size(path) - before < whole / 5  # in proportion to the batch, not to the store
        assert held(store.read()) == held(plain)
    assert not moved_base(store.read())
    again = MergeStore(spark, path)
    assert held(again.read()) == held(plain)
    again.compact()
    assert again.version == 1 and held(MergeStore(spark, path).read()) == held(plain)
    got = again.lookup(spark.createDataFrame([("3",), ("none",)], "k string"), "k", "x int", "url")
    assert {r.k: r.value for r in got.collect()} == {"3": "v3-3", "none": None}


def test_a_killed_writer_leaves_the_store(spark, tmp_path):
    path = str(tmp_path / "s")
    store = MergeStore(spark, path)
    store.upsert(rows(spark, 100))
    store.compact()
    store.upsert(rows(spark, 5, 0, 50))
    want = held(store.read())
    for name in ("delta-0-1", "base-1/rows"):  # begun, never committed
        os.makedirs(f"{path}/{name}")
        with open(f"{path}/{name}/part-0.parquet", "wb") as f:
            f.write(b"half")
    assert store.version == 0 and held(store.read()) == want
    store.upsert(rows(spark, 5, 200, 50))
    store.compact()
    assert store.version == 1 and len(held(store.read())) == 105
