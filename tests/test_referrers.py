"""Paged referrer lists."""
import hashlib

from webfoot.operators import graph


def _pages(edges, size):
    lists = {}
    for src, dst in set(edges):
        if src is not None and dst is not None:
            lists.setdefault(dst, []).append(src)
    out = {}
    for dst, srcs in lists.items():
        srcs.sort(key=lambda s: (hashlib.md5(s.encode()).hexdigest(), s))
        for at in range(0, len(srcs), size):
            out[dst, at // size] = srcs[at:at + size]
    return out


def test_pages_hold_every_referrer_once(spark):
    hot = [(f"s{i}", "hot") for i in range(3_000)]  # a third and more of all links
    rest = [(f"s{i}", f"t{i % 700}") for i in range(4_000)]
    edges = hot + rest + hot[:500] + [("s1", "t1"), (None, "hot"), ("s1", None), ("", ""), ("é", "hot")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {(r.dst, r.page): r.srcs for r in graph.referrer_pages(df, 100).collect()}
    assert got == _pages(edges, 100)
    assert len([k for k in got if k[0] == "hot"]) == 31


def test_hot_target_is_spread(spark):
    """No task numbers a whole target: the window's keys hold the cut."""
    df = spark.createDataFrame([(f"s{i}", "hot") for i in range(50)], "src string, dst string")
    plan = graph.referrer_pages(df, 7)._jdf.queryExecution().executedPlan().toString()
    assert "row_number() windowspecdefinition(dst" in plan
    numbered = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert numbered and all("__wf_cut" in line for line in numbered)


def test_no_edges(spark):
    df = spark.createDataFrame([], "src string, dst string")
    assert graph.referrer_pages(df).collect() == []


def test_records_get_the_first_page(spark):
    pages = graph.referrer_pages(spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("a", "y")], "src string, dst string"), 2)
    rec = spark.createDataFrame([("x", ["old"]), ("y", None), ("z", ["kept"])], "url string, pre_url array<string>")
    got = {r.url: r.pre_url for r in graph.with_referrers(rec, pages).collect()}
    want = _pages([("a", "x"), ("b", "x"), ("c", "x"), ("a", "y")], 2)
    assert got == {"x": want["x", 0], "y": ["a"], "z": ["kept"]}
