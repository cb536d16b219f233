"""O13 rule kinds and the D14 edge forms."""
from webfoot.operators import domains
from webfoot.sources import fixtures as FX


def test_rule_kinds(spark):
    hosts = ["a.b.example.com", "example.com", "x.co.uk", "co.uk", "y.z.ck", "z.ck", "ck", "a.www.ck",
             "www.ck", "localhost", "10.1.2.3", "User@Host.EXAMPLE.NET:8080", "q.org", "h.example.org."]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: r.sld for r in domains.registrable_domains(df, FX.suffix_rules(spark)).collect()}
    assert got == {
        "a.b.example.com": "b.example.com",
        "example.com": ".example.com",        # a bare suffix gives a leading dot
        "x.co.uk": "x.co.uk",
        "co.uk": ".co.uk",
        "y.z.ck": "y.z.ck",                    # *.ck: z.ck is a suffix
        "z.ck": ".z.ck",
        "ck": "ck.",                           # no rule matches: trailing dot
        "a.www.ck": "www.ck",                  # !www.ck: the suffix is ck
        "www.ck": "www.ck",
        "localhost": "localhost.",
        "10.1.2.3": "10.1.2.3.",
        "User@Host.EXAMPLE.NET:8080": "host.example.net",  # userinfo, port, case dropped
        "q.org": "q.org",
        "h.example.org.": "h.example.org",
    }


def test_fallback_join_agrees_with_broadcast_lookup(spark):
    from webfoot.plans import queries as Q
    hosts = Q._domain_hosts(spark, "/root/testdata/sf0.01")
    rules = FX.suffix_rules(spark)
    a = {(r.host, r.sld) for r in domains.registrable_domains(hosts, rules).collect()}
    b = {(r.host, r.sld) for r in domains._domains_by_candidate_join(
        hosts.where("host is not null").distinct(), rules, "host").collect()}
    assert a == b and len(a) > 100


def test_lookup_is_narrow(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("x.example.com",)], "host string")
    out = domains.with_registrable_domain(df, FX.suffix_rules(spark), "host")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    assert {r.host: r.sld for r in out.collect()} == {"a.b.co.uk": "b.co.uk", "x.example.com": "x.example.com"}
