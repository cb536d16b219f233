"""Derived inputs F1-F8 (FIXTURES.md), built by Spark from the given tables.

Each one is a pure function of the driver's tables, so its size grows with
them.  The DuckDB oracle builds the same tables with equivalent SQL
(``webfoot.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from . import tables

# --- fixed values: markup appended to pages for F1, chosen by page_id % 7 and % 5 ---
RICH_SNIPPETS_7 = [
    '<link rel="stylesheet" href="/static/site.css">',
    '<script src="//cdn.example.net/lib.js"></script>',
    "<img src='../img/logo.png' alt=x>",
    "<a href='/single?q=1&amp;r=2'>s</a><a href=/bare>b</a>",
    '<A HREF="../Up/Case">U</A>',
    '<a href="/w">w</a><a href="/w#f">wf</a>',
    '<!-- <a href="/in-comment">c</a> --><script>var s=\'<a href="/in-script">x</a>\';</script>',
]
RICH_SNIPPETS_5 = [
    '<a href="?page=3">q</a>',
    '<a href="./here/">h</a><link href="feed.xml" rel="alternate">',
    '<a href="mailto:info@example.com">m</a>',
    '<a href="HTTP://X.com/A">x</a><script src="/js/app.js" defer></script>',
    '<a href="#top">t</a><img src="data:image/gif;base64,R0lGOD">',
]
# Markup with quotes, raw text and references, by page_id % 6 (F12): before and after the page.
ODD_BEFORE = [
    "", "<!-- <title>no</title> --><script>var t='<title>no</title>';</script>", "<p title='<title>no</title>'>",
    '<title lang=x data-x=">"> Odd\n&copy 2024 &lt;b> </title>', "<textarea><title>no</title></textarea>", "<titles>no</titles>",
]
ODD_AFTER = [
    '<a title="1 > 0" href="/quoted">q</a>', "<div data-x='<a href=\"/no\">'><a href='/after'>a</a></div>",
    "<textarea><a href=/no>n</a></textarea ><img alt='>' src=/i.png>", '<a href="?a=1&copy=2&amp;b=3&lt">r</a><a href>e</a>',
    '<script data-x=">" src="/s.js">document.write("<a href=/no>");</script><link title=">" href=/l>',
    '<a href="/first" href="/no">f</a><style><img src=/no></style><a href="/never',
]
# Outcomes of a try by the first digit of md5(url, number of the try) in F10; digits not named succeed.
FETCH_ERRORS = {"a": "TimeoutError", "b": "NetworkError", "c": "PageError", "d": "TimeoutError", "e": "NetworkError", "f": "PageError"}
FETCH_TRIES = 5
# DNS record types asked for every target (O38): all registered mnemonics.
RTYPES = (
    "TYPE0 A NS MD MF CNAME SOA MB MG MR NULL WKS PTR HINFO MINFO MX TXT RP AFSDB X25 ISDN RT NSAP "
    "NSAP_PTR SIG KEY PX GPOS AAAA LOC NXT SRV NAPTR KX CERT A6 DNAME OPT APL DS SSHFP IPSECKEY RRSIG "
    "NSEC DNSKEY DHCID NSEC3 NSEC3PARAM TLSA SMIMEA HIP NINFO CDS CDNSKEY OPENPGPKEY CSYNC ZONEMD SVCB "
    "HTTPS SPF UNSPEC NID L32 L64 LP EUI48 EUI64 TKEY TSIG IXFR AXFR MAILB MAILA ANY URI CAA AVC AMTRELAY "
    "RESINFO WALLET TA DLV "
).split()
# Types that the captured answers of F3 cover; for the rest the answer is missing.
ANSWERED_TYPES = ["A", "AAAA", "NS", "MX", "TXT", "ANY"]
# Public-suffix style rules for F6.
SUFFIX_RULES = ["com", "net", "org", "uk", "co.uk", "*.ck", "!www.ck",
                "example.com", "example.net", "example.org"]
# --- end of fixed values ---


def _byte(hexstr: Column, pos: int) -> Column:
    """Byte value of two hex digits at 1-based ``pos``."""
    return F.conv(F.substring(hexstr, pos, 2), 16, 10).cast("int")


def page_hosts(pages: DataFrame) -> DataFrame:
    return pages.select(U.url_host("url").alias("fqdn")).distinct()


def pages_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every page plus markup that exercises all four link kinds and the cleaner."""
    p = tables.pages(spark, sf_dir)
    s7 = F.element_at(F.array(*[F.lit(s) for s in RICH_SNIPPETS_7]), (F.col("page_id") % 7 + 1).cast("int"))
    s5 = F.element_at(F.array(*[F.lit(s) for s in RICH_SNIPPETS_5]), (F.col("page_id") % 5 + 1).cast("int"))
    return p.select("page_id", "url", F.concat(F.col("html"), s7, s5).alias("html"))


def pages_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages inside markup that only a reader of whole tags gets right."""
    pick = lambda texts: F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("page_id") % 6 + 1).cast("int"))
    return tables.pages(spark, sf_dir).select("page_id", "url", F.concat(pick(ODD_BEFORE), "html", pick(ODD_AFTER)).alias("html"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order <-> part graph from lineitem, both directions, distinct."""
    li = tables.lineitem(spark, sf_dir).select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("o"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("p"))
    fwd = li.select(F.col("o").alias("src"), F.col("p").alias("dst"))
    back = li.select(F.col("p").alias("src"), F.col("o").alias("dst"))
    return fwd.unionByName(back).distinct()


def dns_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """captured DNS answers per (host, type) for the hosts of ``pages``.

    Hosts whose md5 starts with 'f' have no rows at all (a missing answer).
    """
    hosts = page_hosts(tables.pages(spark, sf_dir)).where(~F.md5("fqdn").startswith("f"))
    probes = hosts.select("fqdn", F.explode(F.array(*[F.lit(t) for t in ANSWERED_TYPES])).alias("rtype"))
    h = F.md5(F.col("fqdn"))
    d0 = F.substring(F.md5(F.concat("fqdn", "rtype")), 1, 1)
    outcome = (F.when(d0.isin(*"01234567"), "answer").when(d0.isin("8", "9"), "no_answer")
               .when(d0 == "a", "no_metaqueries").when(d0 == "b", "no_nameservers")
               .when(d0 == "c", "nxdomain").otherwise("error"))
    name = F.concat(F.col("fqdn"), F.lit("."))
    x, y, z = _byte(h, 1).cast("string"), _byte(h, 3).cast("string"), _byte(h, 5).cast("string")
    a1 = F.concat(name, F.lit(" 300 IN A 10."), x, F.lit("."), y, F.lit("."), z)
    a2 = F.concat(name, F.lit(" 300 IN A 10."), y, F.lit("."), x, F.lit("."), z)
    a_text = F.when(F.substring(h, 7, 1).isin(*"01234567"), F.concat(a1, F.lit("\n"), a2)).otherwise(a1)
    text = (
        F.when(F.col("rtype") == "A", a_text)
        .when(F.col("rtype") == "AAAA", F.concat(name, F.lit(" 300 IN AAAA fd00::"), F.substring(h, 1, 4)))
        .when(F.col("rtype") == "NS", F.concat(name, F.lit(" 3600 IN NS ns1."), name, F.lit("\n"),
                                               name, F.lit(" 3600 IN NS ns2."), name))
        .when(F.col("rtype") == "MX", F.concat(name, F.lit(" 3600 IN MX 10 mail."), name))
        .when(F.col("rtype") == "TXT", F.concat(name, F.lit(' 300 IN TXT "v=spf1 -all"')))
        # An ANY answer also holds an address line; it is no answer to an address query.
        .otherwise(F.concat(name, F.lit(' 300 IN HINFO "RFC8482" ""\n'), name, F.lit(" 300 IN A 10.99."), x, F.lit("."), y))
    )
    return probes.select("fqdn", "rtype", outcome.alias("outcome"),
                         F.when(outcome == "answer", text).alias("rrset_text"))


def whois_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """captured WHOIS answers; hosts with md5 digit 2 = 'f' are missing."""
    hosts = page_hosts(tables.pages(spark, sf_dir))
    h = F.md5(F.col("fqdn"))
    d = F.substring(h, 2, 1)
    outcome = F.when(d.isin("c", "d"), "parser_error").when(d == "e", "error").otherwise("ok")
    ok = outcome == "ok"
    return hosts.where(d != "f").select(
        "fqdn", outcome.alias("outcome"),
        F.when(ok, F.concat(F.lit("Registrar "), F.upper(F.substring(h, 3, 1)))).alias("registrar"),
        F.when(ok, F.date_add(F.lit("2000-01-01").cast("date"), _byte(h, 4) * 13)).alias("created"),
    )


def whois_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4's answers as JSON documents: names and dates single or as lists, name servers, some cut off."""
    h = F.md5("fqdn")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    listed = lambda *cs: F.concat(F.lit("["), F.concat_ws(", ", *[quoted(c) for c in cs]), F.lit("]"))
    low = lambda pos: F.substring(h, pos, 1) < "8"
    day = F.concat(F.date_format("created", "yyyy-MM-dd"), F.lit(" 00:00:00"))
    later = F.concat(F.date_format(F.date_add("created", 1), "yyyy-MM-dd"), F.lit(" 12:30:00"))
    servers = F.when(F.substring(h, 7, 1) < "4", F.lit("null")).otherwise(
        listed(F.concat(F.lit("ns1."), F.col("fqdn")), F.concat(F.lit("ns2."), F.col("fqdn"))))
    text = F.concat(
        F.lit('{"domain_name": '), F.when(low(5), quoted(F.col("fqdn"))).otherwise(listed(F.upper("fqdn"), F.col("fqdn"))),
        F.lit(', "registrar": '), quoted(F.col("registrar")),
        F.lit(', "creation_date": '), F.when(low(6), quoted(day)).otherwise(listed(day, later)),
        F.lit(', "name_servers": '), servers, F.lit("}"))
    cut_off = F.substring(h, 8, 1) == "0"
    return whois_answers(spark, sf_dir).select(
        "fqdn", "outcome", F.when(cut_off, F.substring(text, 1, 40)).otherwise(text).alias("answer"))


def ip_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10.0.0.0/8 in 16 /12 blocks, each with one nested /16; block 13 is a gap.

    IPv6: fd00::/16, and inside it 16 /116 blocks ``fd00::X000`` (X = 0..f)
    except X = d.
    """
    n = tables.nation(spark, sf_dir).select("n_nationkey", "n_name")
    b = spark.range(16).select(F.col("id").cast("int").alias("b")).where(F.col("b") != 13)
    base = F.lit(10 * 2 ** 24) + F.col("b").cast("bigint") * 2 ** 20
    wide = b.select(
        "b", (F.col("b") % 25).alias("nk"),
        base.alias("lo"), (base + 2 ** 20 - 1).alias("hi"), F.lit(12).alias("prefix_len"),
        F.concat(F.lit("AS"), (F.col("b") + 64512).cast("string")).alias("asn"),
        F.concat(F.lit("10."), (F.col("b") * 16).cast("string"), F.lit(".0.0/12")).alias("cidr"))
    off = (F.col("b") * 7) % 16
    nested = b.select(
        "b", ((F.col("b") + 16) % 25).alias("nk"),
        (base + off.cast("bigint") * 2 ** 16).alias("lo"),
        (base + off.cast("bigint") * 2 ** 16 + 2 ** 16 - 1).alias("hi"), F.lit(16).alias("prefix_len"),
        F.concat(F.lit("AS"), (F.col("b") + 65000).cast("string")).alias("asn"),
        F.concat(F.lit("10."), (F.col("b") * 16 + off).cast("string"), F.lit(".0.0/16")).alias("cidr"))
    hexd = F.lower(F.hex(F.col("b")))
    v6 = b.select(
        "b", ((F.col("b") + 7) % 25).alias("nk"), F.lit(None).cast("bigint").alias("lo"),
        F.lit(None).cast("bigint").alias("hi"), F.lit(116).alias("prefix_len"),
        F.concat(F.lit("AS"), (F.col("b") + 64600).cast("string")).alias("asn"),
        F.concat(F.lit("fd00::"), hexd, F.lit("000/116")).alias("cidr"))
    v6_wide = spark.range(1).select(
        F.lit(99).alias("b"), F.lit(24).cast("bigint").alias("nk"), F.lit(None).cast("bigint").alias("lo"),
        F.lit(None).cast("bigint").alias("hi"), F.lit(16).alias("prefix_len"), F.lit("AS64700").alias("asn"),
        F.lit("fd00::/16").alias("cidr"))
    blocks = wide.unionByName(nested).unionByName(v6).unionByName(v6_wide, allowMissingColumns=False)
    return blocks.join(n, blocks["nk"] == n["n_nationkey"]).select(
        "cidr", "lo", "hi", "prefix_len", "asn", F.col("n_name").alias("country"))


def suffix_rules(spark: SparkSession) -> DataFrame:
    """the rule lines as a table ``(rule, kind)``."""
    from ..operators.domains import rules_table
    return rules_table(spark, SUFFIX_RULES)


def final_url_of(url) -> Column:
    """F7 as a column of the capture: http URLs ended up at their https form."""
    u = F.col(url) if isinstance(url, str) else url
    return F.when(u.startswith("http://"), F.concat(F.lit("https://"), F.substring(u, 8, 1 << 20))) \
        .otherwise(u)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages with the URL where the capture ended up."""
    return tables.pages(spark, sf_dir).withColumn("final_url", final_url_of("url"))


def final_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """where each captured URL ended up (http -> https)."""
    return tables.pages(spark, sf_dir).select("url", final_url_of("url").alias("final_url"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: an attempt log from ``events``: one target URL per user, ok unless 'error'."""
    e = tables.events(spark, sf_dir)
    uid = F.col("user_id").cast("string")
    target = F.when(F.col("user_id") % 6 == 0, F.concat(  # an inner URL that each failure rewrites again
        F.lit("http://u"), uid, F.lit(".example.com/?u=https://b.example.net"))) \
        .when(F.col("user_id") % 3 == 0, F.concat(F.lit("http://u"), uid, F.lit(".example.com/"))) \
        .otherwise(F.concat(F.lit("https://u"), uid, F.lit(".example.com/")))
    return e.select(target.alias("target"), F.col("event_id").alias("attempt_id"), "ts",
                    (F.col("event_type") != "error").alias("ok"))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 with links that make the pages a binary tree below page 0, and a link back to it.

    Of pages with one URL the lowest ``page_id`` counts.
    """
    p = pages_rich(spark, sf_dir)
    first = p.groupBy("url").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("p")).select(
        F.col("p.page_id").alias("page_id"), "url", F.col("p.html").alias("html"))
    names = first.select(F.col("page_id").alias("to"), F.col("url").alias("linked"))
    targets = first.select("page_id", F.explode(F.array(
        F.lit(0), F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2)).alias("to")).join(names, "to")
    extra = targets.groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_list(
        F.concat(F.lit('<a href="'), F.col("linked"), F.lit('">l</a>')))), "").alias("extra"))  # three links at most
    return first.join(extra, "page_id", "left").select(
        "page_id", "url", F.concat("html", F.coalesce("extra", F.lit(""))).alias("html"))


def fetch_log(pages: DataFrame, others: DataFrame) -> DataFrame:
    """tries of every URL of ``pages`` and failed ones of half the URLs of ``others(url)``.

    ``(target, attempt_id, ts, ok, error, title, final_url)``; the outcome of a
    try follows from a digest of URL and number.
    """
    hexdigit = F.substring(F.md5(F.concat("url", F.col("k").cast("string"))), 1, 1)
    tries = F.sequence(F.lit(0), F.lit(FETCH_TRIES - 1))
    known = pages.select("url", F.lit(True).alias("captured"), F.explode(tries).alias("k"))
    lost = others.where(F.substring(F.md5("url"), 1, 1) < "8").select("url", F.lit(False).alias("captured"), F.explode(tries).alias("k"))
    failed = hexdigit.isin(list(FETCH_ERRORS)) | ~F.col("captured")
    errors = F.create_map(*[x for kv in FETCH_ERRORS.items() for x in map(F.lit, kv)])
    return known.unionByName(lost).select(
        F.col("url").alias("target"), F.col("k").cast("bigint").alias("attempt_id"),
        F.timestamp_seconds(F.lit(1700000000) - F.col("k")).alias("ts"),  # the last attempt was the first in time
        ~failed, F.when(failed, F.coalesce(errors[hexdigit], F.lit("NotFound"))),
        F.when(hexdigit.isin("d", "e"), F.concat(F.lit("try "), F.col("k").cast("string"))),
        F.when(~failed | hexdigit.isin("e", "f"), F.regexp_replace("url", "^http://", "https://"))
    ).toDF("target", "attempt_id", "ts", "ok", "error", "title", "final_url")
