"""Mixing: Pfair windows, less than one block of deviation, every document once."""
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pandas as pd
import pytest

from webfoot.llm import mixing, oracle, queries

SF = "/root/testdata/sf0.001"


def _check(rows, weights):
    """Every block in its window of the target weight, and less than one block of deviation while all have blocks."""
    parts = dict(zip(sorted(weights), mixing.parts_of([weights[s] for s in sorted(weights)])))
    total, slots = sum(parts.values()), defaultdict(set)
    for r in rows:
        assert r.mix_release == r.mix_block * total // parts[r.source]
        assert r.mix_deadline == -(-(r.mix_block + 1) * total // parts[r.source])
        assert r.mix_release <= r.mix_slot < r.mix_deadline
        slots[r.mix_slot].add((r.source, r.mix_block))
    assert all(len(v) == 1 for v in slots.values())
    last = Counter()
    for t, v in slots.items():
        for s, _ in v:
            last[s] = max(last[s], t)
    done = Counter()
    for t in range(min(last.values()) + 1):
        (s, _), = slots[t]
        done[s] += 1
        for name, p in parts.items():
            assert abs(Fraction((t + 1) * p, total) - done[name]) < 1
    return min(last.values()) + 1


def test_query_windows_and_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op1_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sizes = Counter(r.source for r in got)
    _check(got, {s: n ** 0.5 for s, n in sizes.items()})


def test_deviation_with_given_weights(spark):
    rows = [(i, "abc"[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2, "absent": 9.0}
    got = mixing.mix(df, weights, block_docs=2, period=20).collect()
    assert len(got) == 900
    assert _check(got, {k: weights[k] for k in "abc"}) >= 40
    full = Counter((r.source, r.mix_block) for r in got)
    assert all(n == 2 for n in full.values())


WEIGHTS = [
    {"a": 0.311, "b": 0.2377, "c": 0.1913, "d": 0.1291, "e": 0.0809, "f": 0.05},
    {"big": 7.3} | {f"s{i}": 1.0 for i in range(6)},
    {f"s{i}": 1.0 for i in range(7)},
    {"half": 0.5, "most": 0.4999, "few": 0.07, "fewer": 0.0631},
    {f"s{i}": 1 / (i + 1.37) for i in range(9)},
]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_less_than_one_block_over_many_cycles(spark, weights):
    """Windows, one block a slot and the bound, over more than ten cycles whose cuts fall within windows."""
    total = sum(weights.values())
    rows = [(i, s) for i, s in enumerate(s for s, w in weights.items() for _ in range(int(420 * w / total) + 1))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_docs=1, period=32).collect()
    assert len(got) == len(rows) and _check(got, weights) > 10 * 32


def test_cuts_hold_at_random_weights():
    """Between any two cuts every block fits its window: Hall's condition of each interval, by plain integers."""
    rng, period = random.Random(7), 16
    for _ in range(60):
        weights = [rng.choice([rng.random(), 1.0, 0.25]) + 0.12 for _ in range(rng.randint(2, 7))]
        parts = mixing.parts_of(weights)
        if min(parts) * period < sum(parts):
            continue
        cuts = {t: _cut(parts, t, period) for t in range(0, 12 * period + 1, period)}
        for t in range(0, 12 * period, period):
            assert sum(cuts[t]) == t and _feasible(parts, cuts[t], cuts[t + period], t, t + period)


def _cut(parts, t, period):
    total = sum(parts)
    rest = sorted((-(-(p * t // total + 1) * total // p), i, (p * t // total) * total // p) for i, p in enumerate(parts) if p * t % total)
    for u in range(max(t - period - 2, 0) + 1, t + 1):
        ready = [x for x in rest if x[2] < u]
        if len(ready) > sum(-(-p * u // total) for p in parts) - u:
            rest.remove(ready[0])
    ahead = {i for i, p in enumerate(parts) if p * t % total} - {x[1] for x in rest}
    return [p * t // total + (i in ahead) for i, p in enumerate(parts)]


def _feasible(parts, a, b, begin, end):
    total = sum(parts)
    jobs = [(max(k * total // p, begin), min(-(-(k + 1) * total // p), end)) for i, p in enumerate(parts) for k in range(a[i], b[i])]
    return all(sum(lo <= r and d <= hi for r, d in jobs) <= hi - lo for lo in range(begin, end) for hi in range(lo + 1, end + 1))


def test_sql_follows_the_weights_beyond_one_cycle(spark):
    """The registered SQL on a table of several cycles."""
    sizes = {"a": 26_000, "b": 9_000, "c": 4_000, None: 1_000}
    rows = [(i, s or "\u0000") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    documents = pd.DataFrame(rows, columns=["doc_id", "source"])
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(oracle.oracle_sql()["op1_mixing"]).fetchall()
    names = [c[0] for c in con.description]
    df = spark.createDataFrame(documents)
    got = [tuple(r[c] for c in names) for r in mixing.mix(df).collect()]
    assert sorted(got) == sorted(want) and max(r[names.index("mix_slot")] for r in got) > 3 * 1024
    _check(mixing.mix(df).collect(), {s or "\u0000": n ** 0.5 for s, n in sizes.items()})


def test_null_and_equal_ids(spark, monkeypatch):
    """Null ids are spread over ranges by the whole row; equal ids are numbered by it, whatever the partitioning."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = [(None, "hot", f"text {i}") for i in range(1000)] + [(7, "hot", f"same id {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df).collect()
    assert Counter(r.text for r in got) == Counter(r[2] for r in rows)
    assert len({(r.mix_block, r.mix_place) for r in got}) == len(rows)
    again = mixing.mix(df.repartition(5, "text")).collect()
    assert {r.text: (r.mix_slot, r.mix_place) for r in again} == {r.text: (r.mix_slot, r.mix_place) for r in got}


def test_clashing_names(spark):
    names = ["n", "_wf_before", "_wf_s", "_wf_row", "path", "block", "node", "slot"]
    df = spark.createDataFrame([(i, "ab"[i % 2]) + (i,) * len(names) for i in range(40)],
                               "doc_id long, source string, " + ", ".join(f"{c} long" for c in names))
    got = mixing.mix(df)
    assert got.columns[:10] == df.columns and all(r[c] == r.doc_id for r in got.collect() for c in names)


def test_ranges_number_like_one_sort(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    key = lambda r: (r.doc_id, r.source, r.mix_block, r.mix_place, r.mix_slot)
    one = sorted(map(key, mixing.mix(df).collect()), key=str)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    assert sorted(map(key, mixing.mix(df).collect()), key=str) == one


def test_edge_cases(spark):
    rows = [(1, "a", "t"), (1, "a", "t"), (None, None, None), (2, "", ""), (3, "a`b.c", "x" * 100_000)]
    df = spark.createDataFrame([r + (7,) for r in rows], "doc_id long, source string, text string, MIX_SLOT int")
    got = mixing.mix(df)
    assert got.count() == 5 and [c.lower() for c in got.columns].count("mix_slot") == 1
    ordered = mixing.in_order(mixing.mix(df.drop("MIX_SLOT")))
    assert ordered.columns == ["doc_id", "source", "text"] and ordered.count() == 5
    assert mixing.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 0.0})


def test_main_path_is_native(spark):
    plan = queries.op1_mixing(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


def _drift(rows, weights):
    """The largest distance of a source from its target weight while every source has blocks."""
    slots = {r.mix_slot: r.source for r in rows}
    total, last, done, worst = sum(weights.values()), Counter(), Counter(), 0.0
    for r in rows:
        assert r.mix_release <= r.mix_slot < r.mix_deadline
        last[r.source] = max(last[r.source], r.mix_slot)
    assert len({(r.source, r.mix_block) for r in rows}) == len(slots)
    for t in range(min(last.values()) + 1):
        done[slots[t]] += 1
        worst = max([worst] + [abs((t + 1) * w / total - done[s]) for s, w in weights.items()])
    return worst, min(last.values()) + 1


def test_weights_below_one_slot_are_not_lifted(spark):
    weights = {"big": 1.0, "mid": 0.5, "low": 0.02, "tiny": 0.011, "none": 1e-9}
    counts = {"big": 700, "mid": 350, "low": 14, "tiny": 8, "none": 1}
    rows = [(i, s) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_docs=1, period=16).collect()
    assert len(got) == len(rows) and max(r.mix_slot for r in got if r.source == "none") > 10 ** 8
    rest = [r for r in got if r.source != "none"]
    worst, slots = _drift(rest, {s: w for s, w in weights.items() if s != "none"})
    assert slots > 900 and worst < 3


def test_more_sources_than_one_group_holds(spark):
    rows = [(i, f"site{i % 1500}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), block_docs=1, period=64).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000)) and len({r.mix_slot for r in got}) == 3000
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    blocks = Counter(r.source for r in got if r.mix_slot < 1500)
    assert len(got) == 3000 and max(blocks.values()) <= 2 and max(r.mix_slot for r in got) < 4 * 1500
