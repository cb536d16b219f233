"""Link extraction, cleaning and titles (O16-O20, O30a/b, O45, O23/O24)."""
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from webfoot.functions import html as H
from webfoot.operators import links
from webfoot.sources import tables

SF01 = "/root/testdata/sf0.01"

PAGE = """<html><head><title>  A &amp; B
  &lt;c&gt; </title><script src="/s.js"></script><script>var x='<a href="/no1">';</script>
<style>a{background:url(/no2)}</style><link rel=stylesheet href='/css.css'></head>
<body><!-- <a href="/no3"> --><a href="/a1">x</a><A HREF='/a2?x=1&amp;y=2'>y</A>
<a class=q href=/a3>z</a><abbr href="/no4"></abbr><a data-href="/no5">w</a>
<img src="../i.png" srcset="/no6 2x"><a href="/a1#frag">dup raw differs</a><a href="/a1">same raw</a>
</body></html>"""


def test_extract_kinds_and_cleaning(spark):
    df = spark.createDataFrame([(1, "https://h.example.com/p/q", PAGE)], "page_id long, url string, html string")
    r = links.extract_refs(df).first()
    assert r.title == "A & B <c>"
    got = {(x.kind, x.raw) for x in r.refs}
    assert got == {("script", "/s.js"), ("link", "/css.css"), ("a", "/a1"), ("a", "/a2?x=1&y=2"),
                   ("a", "/a3"), ("img", "../i.png"), ("a", "/a1#frag")}
    b = links.bundle(links.extract_refs(df)).first()
    # D3: two raw refs resolving to one target both count and both appear
    assert b.url_nums == 4
    assert b.next_url.a == sorted(urldefrag(urljoin("https://h.example.com/p/q", u))[0]
                                  for u in ["/a1", "/a2?x=1&y=2", "/a3", "/a1#frag"])
    assert b.next_url.img == ["https://h.example.com/i.png"]


def test_empty_and_null_html(spark):
    df = spark.createDataFrame([(1, "https://h.com/", None), (2, "https://h.com/", "")],
                               "page_id long, url string, html string")
    rows = links.bundle(links.extract_refs(df)).orderBy("page_id").collect()
    for r in rows:
        assert r.url_nums == 0 and r.next_url.a == [] and r.next_url.img == []


def test_fixture_facts_sf001(spark):
    refs = links.extract_refs(tables.pages(spark, SF01))
    b = links.bundle(refs)
    agg = b.agg(F.sum("url_nums").alias("n"), F.count("*").alias("pages")).first()
    assert (agg.n, agg.pages) == (1404, 250)
    rows = links.ref_rows(refs)
    assert rows.select("raw").distinct().count() == 306
    assert rows.select("page_id", "raw").distinct().count() == 1404


def test_resolution_in_rows_matches_urljoin(spark):
    """Independent check: every (page, ref) pair of the fixture against Python's urljoin."""
    refs = links.extract_refs(tables.pages(spark, SF01))
    rows = links.resolved_rows(refs).select("url", "raw", "target").collect()
    assert rows
    for r in rows:
        assert r.target == urldefrag(urljoin(r.url, r.raw))[0], (r.url, r.raw, r.target)


def test_title_entities(spark):
    df = spark.createDataFrame([("<title>x&amp;lt;y &quot;q&quot; &#39;s&#39;\t\n z</title>",)], "h string")
    assert df.select(H.page_title("h")).first()[0] == "x&lt;y \"q\" 's' z"


def test_references_decoded_once(spark):
    cases = {"&eacute;&Eacute;&euro;": "éÉ€", "&#233;&#xE9;&#x1F600;": "éé😀", "&amp;eacute;": "&eacute;", "&nosuch; &amp": "&nosuch; &amp",
             "&#0;&#55296;&#x110000;": "&#0;&#55296;&#x110000;", "a&b;c": "a&b;c", "plain": "plain", "": "", "&apos;&quot;": "'\""}
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    assert {r.h: r.d for r in df.select("h", H.decode_entities("h").alias("d")).collect()} == cases
