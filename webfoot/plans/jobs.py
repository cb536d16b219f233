"""The four record jobs (O70-O73), the crawl report (O51) and the collector shape.

A collector is a function ``DataFrame -> DataFrame``: the seen check (O36)
before, the lookup (a join against captured answers) in the middle and the
store rows (O58) after.  The jobs below are such functions, composed lazily
so Catalyst sees each whole plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import attempts, domains, enrich, links, seen

# --- fixed values: record field names and order of the four record kinds ---
URL_FIELDS = ["url", "fqdn", "sld", "redirect", "pre_url", "next_url", "url_nums", "title",
              "html", "screenshot", "status", "exception"]
DNS_FIELDS = ["fqdn", "sld", "records", "status", "exception"]
WHOIS_FIELDS = ["fqdn", "sld", "whois", "status", "exception"]
IP_FIELDS = ["ip", "fqdn", "ipinfo", "status", "exception"]
# --- end of fixed values ---


def collector(fetch: Callable[[DataFrame], DataFrame], key: str, name: str,
              store: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """Wrap a fetch step with the seen check; use as ``targets.transform(c)``."""
    def run(targets: DataFrame) -> DataFrame:
        t = targets if store is None else seen.unseen(targets, store, key, name)
        return fetch(t)
    return run


def url_records(pages: DataFrame, rules: DataFrame, html_out: str | None = None,
                screen_out: str | None = None, pre_url: DataFrame | None = None) -> DataFrame:
    """O70 for captured pages: one record per page, status 200.

    ``pages(page_id, url, html)``, with ``final_url`` where the capture has
    seen a redirect; ``pre_url(url, pre_url)`` optionally gives the first
    referrer (seeds have none).
    """
    if "final_url" not in pages.columns:
        pages = pages.withColumn("final_url", F.lit(None).cast("string"))
    refs = links.extract_refs(pages, keep=("page_id", "url", "final_url"))
    b = links.bundle(refs)
    rec = b.select(
        "page_id", "url", U.url_host("url").alias("fqdn"),
        F.when(F.col("final_url") != F.col("url"), F.col("final_url")).alias("redirect"),
        "next_url", "url_nums", "title",
        U.artifact_path(html_out, "url", "html").alias("html"),
        U.artifact_path(screen_out, "url", "png").alias("screenshot"),
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("exception"))
    rec = domains.with_registrable_domain(rec, rules, "fqdn", "sld")
    if pre_url is not None:
        rec = rec.join(pre_url.select("url", F.col("pre_url").alias("__wf_pre")), "url", "left") \
            .withColumn("pre_url", F.array(F.col("__wf_pre"))).drop("__wf_pre")
    else:
        rec = rec.withColumn("pre_url", F.array(F.lit(None).cast("string")))
    return rec.select("page_id", *URL_FIELDS)


def failed_url_records(frontier: DataFrame, rules: DataFrame, keep: tuple[str, ...] = (),
                       html_out: str | None = None, screen_out: str | None = None,
                       max_tries: int = attempts.MAX_TRIES) -> DataFrame:
    """O70 failure records (D6, D10): targets with no capture, status 400.

    The record is keyed by the URL as last attempted (the ``www.`` fallback
    after each of ``max_tries`` failures); host, sld and paths come from the
    original URL.  ``keep`` columns of ``frontier`` are carried along.
    """
    rec = frontier.select(
        *keep,
        U.www_fallback_times("node", F.lit(max_tries)).alias("url"), U.url_host("node").alias("fqdn"),
        F.lit(None).cast("string").alias("redirect"),
        F.array(F.col("parent")).alias("pre_url"),
        F.struct(*[F.array().cast("array<string>").alias(k) for k in ("a", "link", "script", "img")])
        .alias("next_url"),
        F.lit(0).alias("url_nums"), F.lit(None).cast("string").alias("title"),
        U.artifact_path(html_out, "node", "html").alias("html"),
        U.artifact_path(screen_out, "node", "png").alias("screenshot"),
        F.lit(400).alias("status"), F.lit(None).cast("string").alias("exception"))
    rec = domains.with_registrable_domain(rec, rules, "fqdn", "sld")
    return rec.select(*keep, *URL_FIELDS)


def dns_records(targets: DataFrame, answers: DataFrame, rules: DataFrame, rtypes: list[str],
                store: DataFrame | None = None) -> DataFrame:
    """Sentinel dropped, de-duplicated, unseen, probed, one record per host."""
    t = seen.drop_sentinel(targets.select("fqdn"), "fqdn").distinct()

    def fetch(x: DataFrame) -> DataFrame:
        return enrich.dns_records_by_host(x, answers, rtypes)

    rec = t.transform(collector(fetch, "fqdn", "dns", store))
    rec = domains.with_registrable_domain(rec, rules, "fqdn", "sld")
    return rec.select("fqdn", "sld", "records", F.lit(200).alias("status"),
                      F.lit(None).cast("string").alias("exception"))


def dns_to_ip(answers: DataFrame, ip_store: DataFrame | None) -> DataFrame:
    """``(ip, fqdn)`` of A/AAAA answers whose ip is not in the IP store."""
    pairs = enrich.host_addresses(answers).distinct()
    return pairs if ip_store is None else seen.unseen(pairs, ip_store, "ip", "ip")


def ip_records(candidates: DataFrame, blocks: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """``candidates(ip, fqdn, src, idx)``; first host to bring an ip wins."""
    first = seen.first_arrival(candidates.select("ip", "fqdn", "src", "idx"), "ip", ["src", "idx", "fqdn"])
    first = first if store is None else seen.unseen(first, store, "ip", "ip")
    e = enrich.ip_enrich(first, blocks)
    info = F.when(F.col("outcome") == "ok", F.struct("cidr", "asn", "country"))
    return e.select("ip", "fqdn", "outcome", info.alias("ipinfo"), F.lit(200).alias("status"),
                    F.lit(None).cast("string").alias("exception"))


def whois_records(targets: DataFrame, answers: DataFrame, rules: DataFrame,
                  store: DataFrame | None = None) -> DataFrame:
    """``targets(fqdn, idx)`` -> the record the store holds per sld.

    Targets already in ``store`` are not looked up.  Answers with a column
    ``answer`` are JSON documents; ``whois`` is then a VARIANT.  The winner of each sld is
    chosen on the slim targets, so one row per sld meets the answers.
    """
    t = seen.drop_sentinel(targets.select("fqdn", "idx"), "fqdn")
    t = t if store is None else seen.unseen(t, store, "fqdn", "whois")
    t = domains.with_registrable_domain(t, rules, "fqdn", "sld")
    collect = enrich.whois_collect_documents if "answer" in answers.columns else enrich.whois_collect
    latest = collect(enrich.whois_latest(t), answers)
    return latest.select("fqdn", "sld", "whois", F.lit(200).alias("status"),
                         F.lit(None).cast("string").alias("exception"), "idx")


def crawl_report(records: DataFrame) -> DataFrame:
    """O51 (the reference's empty report, filled): per (sld, status) totals."""
    return records.groupBy("sld", "status").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.col("url_nums").cast("bigint")).alias("links"),
        F.count_distinct("fqdn").alias("hosts"),
        F.count("redirect").alias("redirects"),
    )
