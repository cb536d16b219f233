"""Punycode labels against the codec of the standard library, and rules that meet both forms."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webfoot.functions import idna
from webfoot.operators import domains

LABELS = ["bücher", "mañana", "例え", "правда", "ü", "a-ü-b", "-ü", "ü-", "😀", "a😀b😀", "ascii", "", "ññññññññ",
          "x" * 62 + "é", "é" * 200, "中文编码测试例子很长的标签" * 4, "\u0080\U0010ffff"]
CITY = "xn--" + "城市".encode("punycode").decode("ascii")


def _expected_ascii(label):
    return label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii")


def _expected_unicode(label):
    if not label.startswith("xn--"):
        return label
    try:
        text = label[4:].encode("ascii").decode("punycode")
    except (UnicodeError, ValueError, OverflowError):
        return label
    return text


def test_encode_and_decode_as_the_codec(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "label string")
    rows = df.select("label", idna.label_to_ascii("label").alias("a"),
                     idna.label_to_unicode(idna.label_to_ascii("label")).alias("back")).collect()
    assert len(rows) == len(LABELS)
    for r in rows:
        assert r.a == _expected_ascii(r.label), r.label
        assert r.back == r.label


def test_random_labels(spark):
    found = []

    @settings(max_examples=150, deadline=None, database=None, derandomize=True)
    @given(st.text(st.characters(exclude_categories=("Cs",), exclude_characters="\n"), max_size=24))
    def draw(text):
        found.append(text)
    draw()
    df = spark.createDataFrame([(x,) for x in found], "label string")
    for r in df.select("label", idna.label_to_ascii("label").alias("a"),
                       idna.label_to_unicode(idna.label_to_ascii("label")).alias("back")).collect():
        assert r.a == _expected_ascii(r.label)
        if not r.label.startswith("xn--"):
            assert r.back == r.label


def test_labels_that_are_no_punycode_stay(spark):
    bad = ["xn--", "xn--99999999999999999999", "xn--a!", "xn--é", "xn--zzzzzzzz", "xn--9", "xn--a-", "xn--" + "9" * 400, None]
    df = spark.createDataFrame([(x,) for x in bad], "label string")
    got = [r.u for r in df.select(idna.label_to_unicode("label").alias("u")).collect()]
    assert got == bad


def test_both_forms_meet_the_same_rule(spark):
    rules = domains.rules_table(spark, ["cn", "公司.cn", "xn--p1ai", "*.中国", "!城市.xn--fiqs8s"])
    hosts = {"www.bücher.公司.cn": "bücher.公司.cn", "www.xn--bcher-kva.xn--55qx5d.cn": "xn--bcher-kva.xn--55qx5d.cn",
             "a.пример.рф": "пример.рф", "a.xn--e1afmkfd.xn--p1ai": "xn--e1afmkfd.xn--p1ai",
             "x.y.z.中国": "y.z.中国", "x.y.z.xn--fiqs8s": "y.z.xn--fiqs8s", "x.城市.中国": "城市.中国",
             f"x.{CITY}.中国": f"{CITY}.中国",
             "WWW.Bücher。公司.CN": "bücher.公司.cn", "plain.cn": "plain.cn"}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: r.sld for r in domains.registrable_domains(df, rules).collect()}
    assert got == hosts
    fallback = {r.host: r.sld for r in domains._domains_by_candidate_join(df, rules, "host").collect()}
    assert fallback == hosts


def test_hosts(spark):
    df = spark.createDataFrame([("Bücher.Example．COM",), (None,), ("",)], "h string")
    got = [tuple(r) for r in df.select(idna.host_to_ascii("h"), idna.host_to_unicode(F.lit("xn--bcher-kva.example.com"))).collect()]
    assert got == [("xn--bcher-kva.example.com", "bücher.example.com"), (None, "bücher.example.com"), ("", "bücher.example.com")]
