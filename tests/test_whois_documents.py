"""Nested WHOIS answers as VARIANT, through the store and back."""
import json

from pyspark.sql import functions as F

from webfoot.operators import enrich
from webfoot.operators import store as S

ANSWERS = [
    ("a.com", "ok", '{"domain_name": ["A.COM", "a.com"], "creation_date": ["2001-02-03 04:05:06", "2001-02-04 00:00:00.5"], '
                    '"name_servers": ["ns1", "ns2"], "org": {"since": "1999-12-31 23:59:59", "n": 3}}'),
    ("b.com", "ok", '{"domain_name": "b.com", "creation_date": "2010-01-01 00:00:00", "name_servers": null, "note": "on 2010-01-01 00:00:00"}'),
    ("c.com", "ok", '{"domain_name": "c.c'), ("d.com", "ok", "[1]"), ("e.com", "ok", None), ("f.com", "parser_error", None),
    ("g.com", "error", "{}"), ("h.com", "ok", "{}"), ("i.com", None, "{}")]


def _documents(spark):
    answers = spark.createDataFrame(ANSWERS, "fqdn string, outcome string, answer string")
    targets = spark.createDataFrame([(f"{c}.com", i, f"{c}.com") for i, c in enumerate("abcdefghij")], "fqdn string, idx long, sld string")
    return enrich.whois_collect_documents(targets, answers)


def test_documents_and_failures(spark):
    got = {r.fqdn: json.loads(r.w) for r in _documents(spark).select("fqdn", F.to_json("whois").alias("w")).collect()}
    assert got["a.com"] == {"domain_name": ["A.COM", "a.com"], "creation_date": ["2001-02-03T04:05:06", "2001-02-04T00:00:00.5"],
                            "name_servers": ["ns1", "ns2"], "org": {"since": "1999-12-31T23:59:59", "n": 3}}
    assert got["b.com"] == {"domain_name": "b.com", "creation_date": "2010-01-01T00:00:00", "name_servers": None,
                            "note": "on 2010-01-01 00:00:00"}
    assert {k: got[k] for k in ("c.com", "d.com", "e.com", "f.com")} == {k: {k: "unknown"} for k in ("c.com", "d.com", "e.com", "f.com")}
    assert got["h.com"] == {}
    assert {k: got[k] for k in ("g.com", "i.com", "j.com")} == {k: {k: "failed"} for k in ("g.com", "i.com", "j.com")}


def test_lists_survive_the_store(spark):
    rows = S.to_store_rows(_documents(spark), "whois", "sld", "idx", ["fqdn", "sld", "whois"])
    back = S.write_version(spark, S.upsert(None, rows), "whois_test").select("key", F.parse_json("value").alias("v"))
    got = {r.key: (r.d, r.n, r.s) for r in back.select(
        "key", *[enrich.variant_texts(F.col("v"), "$.whois." + p).alias(a) for p, a in
                 (("creation_date", "d"), ("domain_name", "n"), ("name_servers", "s"))]).collect()}
    assert got["a.com"] == (["2001-02-03T04:05:06", "2001-02-04T00:00:00.5"], ["A.COM", "a.com"], ["ns1", "ns2"])
    assert got["b.com"] == (["2010-01-01T00:00:00"], ["b.com"], None)
    assert got["c.com"] == got["j.com"] == (None, None, None)
