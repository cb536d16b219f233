"""Tags with quotes, raw-text elements and references (O16-O20, O30b) against literals and the standard library."""
import html
from html.parser import HTMLParser

from pyspark.sql import functions as F

from webfoot.functions import markup
from webfoot.sources import tables

CASES = {
    '<a title="1 > 0" href="/x">': [("a", "/x")],
    "<div data='<a href=\"/no\">'><a href='/y'>": [("a", "/y")],
    "<textarea><a href=/no></textarea ><a href=/z>": [("a", "/z")],
    "<title><a href=/no></title><style><img src=/no></style><xmp><a href=/no></xmp><link href=l>": [("link", "l")],
    "<script src='/s.js'>var t='<a href=\"/no\">';</script><IMG alt=a>b SRC=\"i\"><img src=i2>": [("script", "/s.js"), ("img", "i2")],
    "<!-- <a href=/no> --!><a href=/1><!--><a href=/2><!-- <a href=/no>": [("a", "/1"), ("a", "/2")],
    '<a href="/first" href="/second"><a HREF = /sp ><a href><a hrefx="/no"><a data-href="/no"><a/href=/sl>': [
        ("a", "/first"), ("a", "/sp"), ("a", ""), ("a", "/sl")],
    '<a href="/open><b>text': [],
    "<abbr href=/no></a href=/no><?x <a href=/no>": [],
    '<a href="?a=1&copy=2&amp;b=3&ampx&lt&#65&#x42;&unknown;">': [("a", "?a=1&copy=2&b=3&ampx<AB&unknown;")],
    "<script>never closed <a href=/no>": [],
    "": [], "a < b > c": [],
}


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        want = {"a": "href", "link": "href", "script": "src", "img": "src"}.get(tag)
        for name, value in attrs:
            if name == want:
                self.found.append((tag, value or ""))
                break


def _refs(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    rows = df.select("i", markup.tag_refs("html").alias("refs")).orderBy("i").collect()
    return [None if r.refs is None else [(x.kind, x.raw) for x in r.refs] for r in rows]


def test_literal_cases(spark):
    got = _refs(spark, list(CASES))
    for page, refs in zip(CASES, got, strict=True):
        assert refs == CASES[page], page


def test_null_and_very_long_tags(spark):
    long_tag = "<a " + " ".join(f'd{i}="v>{i}"' for i in range(50_000)) + " href='/end'>" + "<" * 100_000
    assert _refs(spark, [None, long_tag, '<a x="' + "y" * 1_000_000]) == [None, [("a", "/end")], []]


def test_pages_as_the_standard_library(spark):
    pages = [r.html for r in tables.pages(spark, "/root/testdata/sf0.01").select("html").collect()]
    quoted = [p.replace("<li>", "<li title='<a href=\"/no\">' data-x=\"a > b\">") for p in pages]
    for page, refs in zip(pages + quoted, _refs(spark, pages + quoted), strict=True):
        parser = Links()
        parser.feed(page)
        assert refs == parser.found


def test_titles(spark):
    cases = {"<!-- <title>no</title> --><script>'<title>no</title>'</script><p a='<title>'><TITLE x='>'> A\n &copy 1 &notit; &ampamp; <b> </title>":
             "A © 1 ¬it; &amp; <b>", "<title>open &lt": "open <", "<p>none": "", "<textarea><title>no</title></textarea>": "",
             "<title></title><title>second</title>": "", "<titles>no</titles>": ""}
    df = spark.createDataFrame([(i, p) for i, p in enumerate(cases)], "i int, html string")
    got = [r.t for r in df.select("i", markup.title("html").alias("t")).orderBy("i").collect()]
    assert got == list(cases.values())


def test_references_in_text_as_the_standard_library(spark):
    texts = [f"x&{n} y" for n in sorted(html.entities.html5)] + [f"&{n}z" for n in sorted(html.entities.html5) if not n.endswith(";")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", markup.decode_references(F.col("t"), False).alias("d")).collect():
        assert r.d == html.unescape(r.t), r.t
