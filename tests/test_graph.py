"""Traversal against a Python BFS; hub salting gives the same result."""
from collections import defaultdict, deque

from pyspark.sql import functions as F

from webfoot.operators import graph
from webfoot.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _bfs(edges, seed, max_depth):
    adj = defaultdict(set)
    for s, d in edges:
        adj[s].add(d)
    depth, parent = {seed: 0}, {seed: None}
    q = deque([seed])
    while q:
        u = q.popleft()
        if depth[u] == max_depth:
            continue
        for v in adj[u]:
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    for v, dv in depth.items():
        if dv > 0:
            parent[v] = min(u for u in depth if depth[u] == dv - 1 and v in adj[u])
    return {v: (depth[v], parent[v]) for v in depth}


def test_frontier_matches_bfs(spark):
    e = FX.edges(spark, SF)
    edges = [(r.src, r.dst) for r in e.collect()]
    expect = _bfs(edges, "o0", 5)
    seeds = spark.range(1).select(F.lit("o0").alias("node"))
    for hub, per_task in ((10 ** 6, 10 ** 6), (3, 2)):
        got = graph.crawl_frontier(e, seeds, 5, hub_degree=hub, edges_per_task=per_task).collect()
        assert len(got) == len({r.node for r in got})          # no node twice
        assert {r.node: (r.depth, r.parent) for r in got} == expect


def test_frontier_stops_when_empty_and_skips_seen(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    got = {r.node: r.depth for r in graph.crawl_frontier(e, seeds, None).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}
    seen = spark.createDataFrame([("c",)], "node string")
    got = {r.node: r.depth for r in graph.crawl_frontier(e, seeds, None, already_seen=seen).collect()}
    assert got == {"a": 0, "b": 1}


def test_long_chain_costs_the_same_per_level(spark):
    """60 levels: the last levels cost about what the first do, and no table is left in the catalog."""
    import time
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], "src string, dst string")
    seeds = spark.createDataFrame([("n000",)], "node string")
    took = {}
    for depth in (15, None):
        t = time.time()
        got = {r.node: r.depth for r in graph.crawl_frontier(e, seeds, depth).collect()}
        took[depth] = time.time() - t
        assert got == {f"n{i:03d}": i for i in range((depth or 60) + 1)}
    assert took[None] < 8 * took[15]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("wf_bfs")]


def test_seen_check_of_a_large_level_shuffles(spark, monkeypatch):
    monkeypatch.setattr(graph, "BROADCAST_LEVEL", 0)
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert {r.node: r.depth for r in graph.crawl_frontier(e, seeds, None).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_inlinks(spark):
    e = spark.createDataFrame([("p1", "x"), ("p2", "x"), ("p2", "x"), ("p1", "y")], "src string, dst string")
    got = {r.dst: (r.n_inlinks, r.first_referrer) for r in graph.inlinks(e).collect()}
    assert got == {"x": (2, "p1"), "y": (1, "p1")}
