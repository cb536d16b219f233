"""The crawl of fetches against a plain crawler; resolution of tries; stop and resume."""
import os
import random

import pytest

from webfoot.operators import attempts
from webfoot.plans import crawl
from webfoot.sources import fixtures as FX

LOG = "target string, attempt_id long, ts timestamp, ok boolean, error string, title string, final_url string"


def rewrite(url):
    return url if url.startswith("https://www.") else url.replace("https://", "https://www.")


def fetch(url, tries, max_tries=4):
    """``(status, tries, key, exception, title, redirect)`` of a target's tries in order."""
    error = title = redirect = None
    key = url
    for n, (ok, e, t, final) in enumerate(tries[:max_tries], 1):
        title = t if t is not None else title
        redirect = final if final is not None and final != key else redirect
        if ok:
            return 200, n, key, error, title, redirect
        error, key = e, rewrite(key)
    return 400, min(len(tries), max_tries), key, error, title, redirect


def log_rows(spark, tries):
    import datetime
    rows = [(u, i, datetime.datetime(2024, 1, 1, 0, 0, i), *t) for u, ts in tries.items() for i, t in enumerate(ts)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, LOG)


TRIES = {
    "https://a/": [(False, "E1", "first", None), (True, None, None, "https://www.a/")],
    "https://b/": [(False, "E1", "t1", "https://b/x"), (False, "E2", None, None), (False, "E3", "t3", None), (False, "E4", None, None),
                   (True, None, "late", None)],
    "http://c/": [(True, None, None, "https://c/")],
    "https://www.d/": [(False, "E", None, "https://www.d/login"), (True, None, None, "https://www.d/")],
    "https://e/?u=https://f/": [(False, "E", None, None)],
}


def test_tries_are_settled_as_a_crawler_settles_them(spark):
    got = {r.target: (r.status, r.tries, r.url, r.exception, r.title, r.redirect)
           for r in attempts.resolve_fetches(log_rows(spark, TRIES)).collect()}
    assert got == {u: fetch(u, t) for u, t in TRIES.items()}
    assert got["https://a/"] == (200, 2, "https://www.a/", "E1", "first", None)
    assert got["https://b/"] == (400, 4, "https://www.b/", "E4", "t3", "https://b/x")


def plain_crawl(links, tries, seeds, store=()):
    """``{target: (depth, parent, status, key)}`` level by level; what has a log is recorded, all that is met is seen."""
    seen, front, out, depth = set(store), {s: None for s in seeds if s not in store}, {}, 0
    while front:
        keys, following = set(), {}
        for u, parent in front.items():
            if u in tries:
                status, _, key, *_ = fetch(u, tries[u])
                keys.add(key)
                out[u] = depth, parent, status, key
                for v in links.get(u, ()) if status == 200 else ():
                    following[v] = min(key, following.get(v, key))
        seen |= set(front) | keys
        front, depth = {v: p for v, p in following.items() if v not in seen}, depth + 1
    return out


@pytest.fixture(scope="module")
def site(spark):
    rng = random.Random(7)
    urls = [f"https://{'www.' * (i % 3 == 0)}h{i}/" for i in range(60)] + [f"https://www.h{i}/" for i in (1, 2, 4, 5)]
    urls = list(dict.fromkeys(urls))
    links = {u: rng.sample(urls, 3) + ["https://nowhere/"] * (i % 5 == 0) for i, u in enumerate(urls)}
    tries = {u: [(rng.random() < 0.6, f"E{n}", None, None) for n in range(5)] for u in urls if rng.random() < 0.95}
    tries[urls[0]] = [(True, None, None, None)]
    links[urls[0]].append("https://k/")  # its record gets the key that its own page links to
    links["https://k/"], links["https://www.k/"] = ["https://www.k/"], []
    tries["https://k/"], tries["https://www.k/"] = [(False, "E", None, None), (True, None, None, None)], [(True, None, None, None)]
    pages = spark.createDataFrame([(u, "<title>T " + u + "</title>" + "".join(f'<a href="{v}">x</a>' for v in vs))
                                   for u, vs in links.items()], "url string, html string")
    table = crawl.fetch_table(pages, log_rows(spark, tries), FX.suffix_rules(spark), "/h", "/p").cache()
    return urls, links, tries, table


def found(records):
    return {r.node: (r.depth, r.pre_url[0], r.status, r.url) for r in records.collect()}


def test_crawl_against_a_plain_crawler(spark, site):
    urls, links, tries, table = site
    seeds = spark.createDataFrame([(urls[0],), (urls[0],), (None,)], "node string")
    records = crawl.crawl(table, seeds)
    want = plain_crawl(links, tries, urls[:1])
    assert found(records) == want and max(d for d, *_ in want.values()) >= 4
    for r in records.collect():
        good = r.status == 200
        assert r.title == ("T " + r.node if good else None) and r.fqdn == r.node.split("/")[2]
        assert sorted(r.next_url.a) == (sorted(links[r.node]) if good else []) and r.url_nums == len(r.next_url.a)
    assert want["https://k/"][3] == "https://www.k/" and "https://www.k/" not in want
    store = [urls[5], next(v for v in links[urls[0]])]
    again = crawl.crawl(table, seeds, store=spark.createDataFrame([(u,) for u in store], "key string"))
    assert found(again) == plain_crawl(links, tries, urls[:1], store)


def test_a_stopped_crawl_goes_on_after_its_last_whole_level(spark, site, tmp_path):
    urls, links, tries, table = site
    seeds, base = spark.createDataFrame([(urls[0],)], "node string"), str(tmp_path / "c")
    assert set(found(crawl.crawl(table, seeds, base, max_depth=1))) == {u for u, r in plain_crawl(links, tries, urls[:1]).items() if r[0] <= 1}
    half = tmp_path / "c" / "depth=2"
    half.mkdir()
    (half / "part-00000.parquet").write_bytes(b"half a file")
    written = {d: sorted((f, os.stat(tmp_path / "c" / d / f).st_mtime_ns) for f in os.listdir(tmp_path / "c" / d)) for d in ("depth=0", "depth=1")}
    assert found(crawl.crawl(table, seeds, base)) == plain_crawl(links, tries, urls[:1])
    assert written == {d: sorted((f, os.stat(tmp_path / "c" / d / f).st_mtime_ns) for f in os.listdir(tmp_path / "c" / d)) for d in written}


def test_empty_inputs(spark, site):
    _, _, _, table = site
    none = spark.createDataFrame([], "node string")
    assert crawl.crawl(table, none).count() == 0
    assert crawl.crawl(table.limit(0), spark.createDataFrame([("https://x/",)], "node string")).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("wf_fetch_")]
