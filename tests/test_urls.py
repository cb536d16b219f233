"""Golden cases for reference resolution and the other URL expressions.

Python's urljoin/urldefrag is used here only as an independent check.
"""
from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from webfoot.functions import urls

BASES = [
    "https://h.example.com:8080/a/b/c?x=1#f",
    "https://h.example.com",
    "http://h.example.com/a//b/c",
    "https://h.example.com/dir/",
    "http://ththre.example.com/fr/825?page=2&ref=x",
]
REFS = [
    "", "#top", "?y=2", "d", "./d", "../d", "../../../d", "/d", "..", ".",
    "/a/./b/../c", "d//e", "/d//e", "//o.example/p", "https://o.example",
    "https:g", "http:g", "mailto:a@b", "javascript:void(0)", "tel:1",
    "data:text/plain,x", "HTTP://X.com/A", " /sp ", "/w\n/z", "d;p",
    "für", "a b", "/x#", "/x?", "/x?#", "http://[bad", "/w#f", "/w",
    "../..", "./", "d/.", "d/..", "?", "#", "//o.example/a/../b", "x/../../y",
    "HTTPS://O.example/A#f", "mailto:a@b#x", "1abc:x", "/The", "/the,",
]


def _py(base, ref):
    try:
        return urldefrag(urljoin(base, ref))[0]
    except ValueError:
        return None


def test_resolve_matches_urljoin(spark):
    rows = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(rows, "base string, ref string")
    got = urls.resolve_refs(df, "base", "ref", "out").collect()
    bad = [(x.base, x.ref, x.out, _py(x.base, x.ref)) for x in got if x.out != _py(x.base, x.ref)]
    assert not bad, bad[:10]
    assert len(got) == len(rows)


def test_host_digest_and_fixes(spark):
    vals = ["https://u:p@H.Example.com:81/x", "h_x/y", "//cdn.example.net/a", "http://a b.com/c d",
            "mailto:x@y", "https://ads-track.example.org"]
    df = spark.createDataFrame([(v,) for v in vals], "u string")
    out = df.select("u", urls.url_host("u").alias("h"), urls.key_digest("u").alias("k"),
                    urls.fix_scheme("u").alias("f"), urls.www_fallback("u").alias("w")).collect()
    import hashlib
    for r in out:
        assert r.h == urlparse(r.u).netloc
        assert r.k == hashlib.md5(r.u.encode()).hexdigest()
        assert r.f == (r.u if "://" in r.u else "http://" + r.u)
    assert [r.w for r in out] == ["https://www.u:p@H.Example.com:81/x", "h_x/y", "//cdn.example.net/a", "http://a b.com/c d",
                                  "mailto:x@y", "https://www.ads-track.example.org"]


def test_www_fallback_replaces_every_occurrence(spark):
    df = spark.createDataFrame([("https://a.com/?next=https://b.com",), ("http://a.com",),
                                ("https://www.a.com",)], "u string")
    got = [r[0] for r in df.select(urls.www_fallback("u")).collect()]
    assert got == ["https://www.a.com/?next=https://www.b.com", "http://a.com", "https://www.a.com"]


def test_artifact_path(spark):
    df = spark.createDataFrame([("http://h.com:8/x",)], "u string")
    r = df.select(urls.artifact_path("/out", "u", "html").alias("p"),
                  urls.artifact_path(None, "u", "png").alias("q")).first()
    import hashlib
    assert r.p == "/out/h.com:8_" + hashlib.md5(b"http://h.com:8/x").hexdigest() + ".html"
    assert r.q is None


def test_resolution_idempotent_on_absolute_targets(spark):
    """Resolving an already resolved http(s) URL against any base gives it back."""
    rows = [(b, r) for b in BASES for r in REFS]
    df = urls.resolve_refs(spark.createDataFrame(rows, "base string, ref string"), "base", "ref", "t")
    df = df.where("t rlike '^https?://'")
    again = urls.resolve_refs(df, "base", "t", "t2").collect()
    assert again and all(x.t2 == x.t for x in again)


def test_follow_only_http_schemes(spark):
    from webfoot.operators import links
    html = '<a href="/x">x</a><a href="mailto:a@b.c">m</a><a href="javascript:void(0)">j</a>'
    df = spark.createDataFrame([(1, "https://h.com/", html)], "page_id long, url string, html string")
    refs = links.extract_refs(df)
    assert {r.dst for r in links.page_edges(refs).collect()} == {"https://h.com/x", "mailto:a@b.c",
                                                                  "javascript:void(0)"}
    assert {r.dst for r in links.page_edges(refs, schemes=("http", "https")).collect()} == {"https://h.com/x"}
