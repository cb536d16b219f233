"""DNS / IP / WHOIS enrichment against brute force."""
from webfoot.operators import domains, enrich
from webfoot.plans import queries as Q
from webfoot.sources import fixtures as FX

SF01 = "/root/testdata/sf0.01"


def test_dns_outcome_codes(spark):
    probes = spark.createDataFrame([(h, t) for h in ("a.com", "b.com", "c.com") for t in ("A", "MX")],
                                   "fqdn string, rtype string")
    ans = spark.createDataFrame(
        [("a.com", "A", "answer", "a.com. 300 IN A 10.0.0.1"), ("a.com", "MX", "no_answer", None),
         ("b.com", "A", "nxdomain", None), ("b.com", "MX", "no_nameservers", None),
         ("c.com", "A", "no_metaqueries", None)],
        "fqdn string, rtype string, outcome string, rrset_text string")
    got = {(r.fqdn, r.rtype): r.text for r in enrich.dns_collect(probes, ans).collect()}
    assert got == {("a.com", "A"): "a.com. 300 IN A 10.0.0.1", ("a.com", "MX"): "No Answer",
                   ("b.com", "A"): "NXDOMAIN", ("b.com", "MX"): "SERVFAIL",
                   ("c.com", "A"): "Not Allow", ("c.com", "MX"): "UNKNOWN"}


def test_rrset_rows_parse_multi_line(spark):
    ans = spark.createDataFrame([("h", "A", "answer", "h. 300 IN A 10.0.0.1\nh. 300 IN A 10.0.0.2")],
                                "fqdn string, rtype string, outcome string, rrset_text string")
    rows = enrich.rrset_rows(ans).orderBy("line_no").collect()
    assert [(r.line_no, r.ttl, r.rclass, r.type, r.rdata) for r in rows] == [
        (0, 300, "IN", "A", "10.0.0.1"), (1, 300, "IN", "A", "10.0.0.2")]


def test_ip_prefix_match_against_brute_force(spark):
    """Longest-prefix match (IPv4 and IPv6) against Python's ipaddress module."""
    import ipaddress
    blocks = [(ipaddress.ip_network(r.cidr), r.cidr) for r in FX.ip_blocks(spark, SF01).collect()]
    addrs = [r.ip for r in enrich.host_addresses(FX.dns_answers(spark, SF01)).collect()]
    addrs += ["10.208.0.1", "10.255.255.255", "9.0.0.1", "10.1.2.300", "fd00::1", "FD00::D123", "fd00::d123",
              "fe80::1", "::", "1::2::3", "fd00:0:0:0:0:0:0:a001", "not an ip", "::ffff:zz",
              "::ffff:10.1.2.3", "fd00::1.2.3.4", "1.2.3", "::1.2.3.400", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8:9"]
    df = spark.createDataFrame([(a,) for a in addrs], "ip string")
    got = {r.ip: (r.outcome, r.cidr) for r in enrich.ip_enrich(df, FX.ip_blocks(spark, SF01)).collect()}
    for a in addrs:
        try:
            ip = ipaddress.ip_address(a.lower())
        except ValueError:
            assert got[a] == ("unknown", None), a
            continue
        hits = [(n, c) for n, c in blocks if n.version == ip.version and ip in n]
        if not hits:
            assert got[a] == ("failed", None), a
        else:
            assert got[a] == ("ok", max(hits, key=lambda h: h[0].prefixlen)[1]), a


def test_two_origins_of_one_prefix_are_decided(spark):
    blocks = [("10.0.0.0/8", "AS2", "b"), ("10.0.0.0/8", "AS1", "z"), ("10.0.0.0/33", "bad", "x"), ("10.0.0/8", "bad", "x"), ("fd00::/8", "AS6", "s")]
    df = spark.createDataFrame([("10.9.9.9",), ("fd00::1",)], "ip string")
    b = spark.createDataFrame(blocks, "cidr string, asn string, country string").repartition(3)
    assert {r.ip: r.asn for r in enrich.ip_enrich(df, b).collect()} == {"10.9.9.9": "AS2", "fd00::1": "AS6"}
    from webfoot.operators.prefixjoin import bad_blocks
    assert bad_blocks(b).count() == 2


def test_prefix_join_without_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = enrich.ip_enrich(spark.createDataFrame([("10.16.0.9",), ("x",)], "ip string"), FX.ip_blocks(spark, SF01))
        assert {r.ip: r.outcome for r in rows.collect()} == {"10.16.0.9": "ok", "x": "unknown"}
    finally:
        spark.conf.set(key, saved)


def test_an_address_line_of_another_query_is_no_address(spark):
    ans = spark.createDataFrame([("h", "ANY", "answer", "h. 300 IN A 10.0.0.1"), ("h", "A", "answer", "h. 300 IN A 10.0.0.2\nh. 300 IN CNAME g.")],
                                "fqdn string, rtype string, outcome string, rrset_text string")
    assert [tuple(r) for r in enrich.host_addresses(ans).collect()] == [("10.0.0.2", "h")]
    assert [tuple(r) for r in enrich.address_lists(ans.unionByName(ans)).collect()] == [("h", ["10.0.0.2"])]


def test_ip_enrich_plans_no_nested_loop(spark):
    df = Q.ip_enrich(spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_whois_latest_matches_reference_store_semantics(spark):
    """Replay the reference: seen-by-fqdn, write-by-sld, last writer wins."""
    targets = Q._whois_targets(spark, SF01)
    with_sld = domains.with_registrable_domain(targets, FX.suffix_rules(spark), "fqdn", "sld")
    rows = sorted(with_sld.collect(), key=lambda r: r.idx)
    store = {}
    for r in rows:
        if r.fqdn in store:          # is_seen(target) looks the fqdn up among written keys
            continue
        store[r.sld] = (r.fqdn, r.idx)
    got = {r.sld: (r.fqdn, r.idx) for r in enrich.whois_latest(with_sld).collect()}
    assert got == store


def test_dns_by_host_equals_row_form(spark):
    from webfoot.sources import tables
    targets = FX.page_hosts(tables.pages(spark, SF01))
    answers = FX.dns_answers(spark, SF01)
    a = {r.fqdn: dict(r.records) for r in enrich.dns_records_by_host(targets, answers, FX.RTYPES).collect()}
    rows = enrich.dns_record_maps(enrich.dns_collect(enrich.dns_probes(targets, FX.RTYPES), answers))
    b = {r.fqdn: dict(r.records) for r in rows.collect()}
    assert a == b and len(a) == 58
