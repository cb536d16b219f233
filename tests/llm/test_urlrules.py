"""URL rules against a direct reading of the rules."""
import re

from webfoot.llm import queries, urlrules

SF = "/root/testdata/sf0.001"


def _judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    best = None
    for verdict, h, p in rules:
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), verdict)
            if best is None or key > best[0]:
                best = (key, h + p, verdict)
    return host, path, best and best[1], best[2] if best else default


def test_query_and_cases(spark):
    rules = queries.URL_RULES
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in queries.op6_url_filter(spark, SF).collect()}
    assert got == {i: _judge(u, rules) for i, u in pages.items()}


def test_edge_cases(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "a.b.c.d", "/x/y/zed"),
             ("allow", "x.net", "/a"), ("block", "x.net", "/a"), ("block", "", "/"), ("block", "y.org", "")]
    deep = "http://" + "l." * 300 + "net/" + "p/" * 300
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "HTTP://A.Example.NET/en/x?y://z#t",
            "http://example.net/en", "http://a.b.c.d/x/y/zedx", "http://z.a.b.c.d/x/y/ze", "http://x.net/ab", "http://y.org",
            "http://q.y.org?x", "http://notnet/", "http://.net/", "x://y://net/", "http://net?/", deep, deep,
            "http://É.net/ü", "http://a\nb.net/\n"]
    df = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, Verdict string")
    got = urlrules.judge(df, urlrules.rule_table(spark, rules)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == _judge(r.url, rules), r.url
    assert urlrules.judge(df.limit(0), urlrules.rule_table(spark, rules)).count() == 0
    none = urlrules.judge(df, urlrules.rule_table(spark, rules).limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}


def test_main_path_is_native(spark):
    plan = queries.op6_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


def test_clashing_names(spark):
    names = ["u_host", "won_verdict", "rule_", "_wf_head", "_wf_row", "won"]
    df = spark.createDataFrame([("http://a.net/x",) + tuple(names)], "url string, " + ", ".join(f"{c} string" for c in names))
    row = urlrules.judge(df, urlrules.rule_table(spark, [("block", "net", "/")])).first()
    assert all(row[c] == c for c in names) and (row.verdict, row.rule) == ("block", "net/")
