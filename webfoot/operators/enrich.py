"""DNS, IP and WHOIS enrichment against captured answers.

Live lookups are re-aimed as joins against captured answer tables.  Every
grouping here is bounded per key: a host has one row per record type, an
address list is one DNS answer, and WHOIS/IP winners are picked with
partial aggregates (``min_by``/``max_by``), so a hot key does not pile up
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefixjoin import longest_prefix_match

# --- fixed values: DNS outcome texts, by failure class (O31) ---
DNS_OUTCOME_TEXT = [("no_answer", "No Answer"), ("no_metaqueries", "Not Allow"),
                    ("no_nameservers", "SERVFAIL"), ("nxdomain", "NXDOMAIN")]
DNS_UNKNOWN = "UNKNOWN"
# WHOIS (O32) and IP (O33) failure markers; note they are opposite in sense.
WHOIS_PARSER_ERROR = "unknown"
WHOIS_OTHER_ERROR = "failed"
IP_LOOKUP_ERROR = "failed"
IP_OTHER_ERROR = "unknown"
# Record types whose answers carry addresses (O30e).
ADDRESS_TYPES = ["A", "AAAA"]
# --- end of fixed values ---

# A date with a time as a JSON text.
DATE_TEXT = r'"(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2}(?:\.\d+)?)"'
RRSET_LINE = r"^(\S+)\s+(\d+)\s+(\S+)\s+(\S+)\s+(.*)$"


def dns_outcome(outcome: Column, text: Column) -> Column:
    """Answer text, or the outcome code of the failure class."""
    out = F.when(outcome == "answer", text)
    for code, label in DNS_OUTCOME_TEXT:
        out = out.when(outcome == code, F.lit(label))
    return out.otherwise(F.lit(DNS_UNKNOWN))


def dns_probes(targets: DataFrame, rtypes: list[str], fqdn: str = "fqdn") -> DataFrame:
    """Every target with every record type (an explode of a fixed list, no join)."""
    return targets.select(F.col(fqdn).alias("fqdn"),
                          F.explode(F.array(*[F.lit(t) for t in rtypes])).alias("rtype"))


def dns_collect(probes: DataFrame, answers: DataFrame) -> DataFrame:
    """Probes left-joined to captured answers; a missing answer is UNKNOWN."""
    a = answers.select("fqdn", "rtype", "outcome", "rrset_text")
    j = probes.join(a, ["fqdn", "rtype"], "left")
    return j.select("fqdn", "rtype", dns_outcome(F.col("outcome"), F.col("rrset_text")).alias("text"),
                    "outcome", "rrset_text")


def dns_records_by_host(targets: DataFrame, answers: DataFrame, rtypes: list[str]) -> DataFrame:
    """O39 + O47 per host: ``(fqdn, records map<rtype, text>)`` for distinct targets.

    Answers of hosts that are no targets go first (semi-join), then each
    (host, type) is reduced to its smallest answer with partial aggregation:
    a host captured daily for years comes to one row per type.  Only these
    are gathered per host (bounded by the types), and joined to the targets.
    """
    asked = answers.join(targets.select("fqdn"), "fqdn", "left_semi").where(F.col("rtype").isin(*rtypes))
    per_type = asked.groupBy("fqdn", "rtype").agg(F.min(F.struct("outcome", "rrset_text")).alias("a")).select(
        "fqdn", "rtype", "a.outcome", "a.rrset_text")
    per_host = per_type.groupBy("fqdn").agg(
        F.array_sort(F.collect_list(F.struct("rtype", "outcome", "rrset_text"))).alias("__wf_ans"))
    j = targets.select("fqdn").join(per_host, "fqdn", "left")

    def entry(t):
        hit = F.get(F.filter(F.coalesce(F.col("__wf_ans"), F.array().cast(per_host.schema["__wf_ans"].dataType)),
                             lambda a: a.rtype == t), 0)
        return F.struct(t.alias("key"), dns_outcome(hit.outcome, hit.rrset_text).alias("value"))

    types = F.array(*[F.lit(t) for t in rtypes])
    return j.select("fqdn", F.map_from_entries(F.transform(types, entry)).alias("records"))


def dns_record_maps(collected: DataFrame) -> DataFrame:
    """One map record type -> text per host (bounded by the type list)."""
    return collected.groupBy("fqdn").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("rtype", "text")))).alias("records"))


def rrset_rows(answers: DataFrame) -> DataFrame:
    """Zone-style lines of each answer as rows (name, ttl, class, type, rdata)."""
    lines = answers.where(F.col("rrset_text").isNotNull()).select(
        "fqdn", "rtype", F.posexplode(F.split("rrset_text", "\n")).alias("line_no", "line"))
    g = lambda i: F.regexp_extract("line", RRSET_LINE, i)
    return lines.where(F.col("line").rlike(RRSET_LINE)).select(
        "fqdn", "rtype", "line_no",
        g(1).alias("name"), g(2).try_cast("int").alias("ttl"), g(3).alias("rclass"),
        g(4).alias("type"), g(5).alias("rdata"))


def host_addresses(answers: DataFrame) -> DataFrame:
    """O30e: ``(ip, fqdn)`` of the A and AAAA lines in answers to A and AAAA queries."""
    rows = rrset_rows(answers.where(F.col("rtype").isin(*ADDRESS_TYPES))).where(F.col("type").isin(*ADDRESS_TYPES))
    return rows.select(F.col("rdata").alias("ip"), "fqdn")


def address_lists(answers: DataFrame) -> DataFrame:
    """Per host, its distinct addresses sorted."""
    return host_addresses(answers).distinct().groupBy("fqdn").agg(
        F.array_sort(F.collect_list("ip")).alias("ips"))


def ip_enrich(ips: DataFrame, blocks: DataFrame, ip: str = "ip") -> DataFrame:
    """O41 + O33: registry answer per address by longest-prefix match (IPv4 and IPv6).

    Output: every input row plus ``outcome`` (ok | failed | unknown), and
    ``cidr``, ``asn``, ``country`` of the most specific block.  Not an address
    at all: ``unknown``; an address no block covers: ``failed``.
    """
    best = longest_prefix_match(ips, ip, blocks, ["asn", "country"])
    j = ips.join(best.withColumnRenamed("ip", "__wf_ip"), F.col(ip) == F.col("__wf_ip"), "left")
    outcome = (F.when(F.col("__wf_ip").isNull(), F.lit(IP_OTHER_ERROR))
               .when(F.col("__wf_match").isNull(), F.lit(IP_LOOKUP_ERROR))
               .otherwise(F.lit("ok")))
    return j.select(*ips.columns, outcome.alias("outcome"),
                    F.col("__wf_match.cidr").alias("cidr"), F.col("__wf_match.asn").alias("asn"),
                    F.col("__wf_match.country").alias("country"))


def whois_outcome(fqdn: Column, outcome: Column, registrar: Column, created: Column) -> Column:
    """The answer as a map, or ``{fqdn: unknown}`` (parser error) / ``{fqdn: failed}``."""
    ok_map = F.create_map(F.lit("created"), F.date_format(created, "yyyy-MM-dd"),
                          F.lit("domain_name"), fqdn, F.lit("registrar"), registrar)
    return (F.when(outcome == "ok", ok_map)
            .when(outcome == "parser_error", F.create_map(fqdn, F.lit(WHOIS_PARSER_ERROR)))
            .otherwise(F.create_map(fqdn, F.lit(WHOIS_OTHER_ERROR))))


def whois_document(fqdn: Column, outcome: Column, answer: Column) -> Column:
    """O32 for nested answers: the JSON answer as a VARIANT, whatever its fields are.

    Dates with a time become ISO text wherever they stand, lists included
    (O69).  An answer that is no JSON object is a parser error: ``{fqdn:
    unknown}``; any other failure, a missing answer included, ``{fqdn: failed}``.
    """
    marker = lambda text: F.parse_json(F.to_json(F.create_map(fqdn, F.lit(text))))
    parsed = F.try_parse_json(F.regexp_replace(answer, DATE_TEXT, '"$1T$2"'))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return (F.when((outcome == "ok") & is_object, parsed)
            .when(outcome.isin("ok", "parser_error"), marker(WHOIS_PARSER_ERROR))
            .otherwise(marker(WHOIS_OTHER_ERROR)))


def whois_collect_documents(targets: DataFrame, answers: DataFrame) -> DataFrame:
    """O42 with nested answers ``(fqdn, outcome, answer)``: ``whois`` is a VARIANT."""
    a = answers.select("fqdn", "outcome", "answer")
    return targets.join(a, "fqdn", "left").select(
        "fqdn", "idx", "sld", whois_document(F.col("fqdn"), F.col("outcome"), F.col("answer")).alias("whois"))


def variant_texts(v: Column, path: str) -> Column:
    """The texts at ``path``: a list as it is, a single value as a list of one, null where there is none."""
    many = F.try_variant_get(v, path, "array<string>")
    one = F.try_variant_get(v, path, "string")
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith("ARRAY"), many).when(
        one.isNotNull(), F.array(one))


def whois_collect(targets: DataFrame, answers: DataFrame) -> DataFrame:
    """Targets ``(fqdn, idx, sld)`` left-joined to captured WHOIS answers."""
    a = answers.select("fqdn", "outcome", "registrar", "created")
    j = targets.join(a, "fqdn", "left")
    return j.select("fqdn", "idx", "sld", whois_outcome(F.col("fqdn"), F.col("outcome"),
                                                        F.col("registrar"), F.col("created")).alias("whois"))


def whois_latest(collected: DataFrame) -> DataFrame:
    """The record the store ends up with per sld.

    A target is looked up when ``fqdn <> sld`` or it is the first of its sld
    (a later ``fqdn = sld`` target finds the sld key already written).  Of the
    looked-up targets the one with the highest order writes last.  As
    aggregates: the highest-order ``fqdn <> sld`` target if there is one,
    else the first target.
    """
    row = F.struct(*[F.col(c) for c in collected.columns if c != "sld"])
    nonself = F.when(F.col("fqdn") != F.col("sld"), F.col("idx"))
    g = collected.groupBy("sld").agg(
        F.max_by(row, nonself).alias("__wf_last"),
        F.max(nonself).alias("__wf_has"),
        F.min_by(row, F.col("idx")).alias("__wf_first"),
    )
    win = F.when(F.col("__wf_has").isNotNull(), F.col("__wf_last")).otherwise(F.col("__wf_first"))
    cols = [c for c in collected.columns if c != "sld"]
    return g.select("sld", *[win[c].alias(c) for c in cols])
