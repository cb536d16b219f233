"""Registrable domain ``domain.suffix`` by public-suffix rules.

The rules are a table ``(rule, kind)`` with kind ``normal`` (``co.uk``),
``wildcard`` (``*.ck``) or ``exception`` (``!www.ck``).  A host is cut into
its candidate suffixes (one row per label count), joined to the rules on the
suffix text, and the prevailing match is chosen per host:

* an exception rule wins; the public suffix is the rule minus its first label,
* otherwise the longest normal or wildcard match,
* no match: no suffix, the registrable domain is ``domain + '.'``,
* the host is itself a suffix: ``'.' + suffix``.

Per row (:func:`with_registrable_domain`) the lookup is narrow: a rule has
at most K labels (K is read from the rule table), so the host's last 1..K
labels are looked up with K left joins against the broadcast rule table.
Nothing is shuffled and a very popular host costs nothing extra.  The rule
table is broadcast only behind a row-count check; past the bound the work
falls back to one row per *distinct* host joined back on the host.

Hosts and rules meet in Unicode: a label in Punycode (``xn--``) is read first,
so both forms of a name fall under the same rule.  The result keeps the form
that the host came in.  Where no rule has such a label or one beyond ASCII the
reading could change nothing and is left out of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import idna

# --- fixed values ---
# Hosts that are IPv4 literals have no suffix (domain is the whole address).
IPV4_PATTERN = r"^(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)$"
# A rule that is not plain ASCII text.
IDN_PATTERN = r"(^|\.)xn--|[^\x00-\x7f]"
# Upper bound on a suffix-rule table we are willing to broadcast.
MAX_BROADCAST_RULES = 200_000
# --- end of fixed values ---


def bare_host(netloc) -> Column:
    """Lower-case host of a netloc: userinfo and port removed, one trailing dot dropped."""
    c = F.col(netloc) if isinstance(netloc, str) else netloc
    h = F.regexp_extract(c, r"^(?:.*@)?([^:]*)", 1)
    return F.regexp_replace(F.lower(idna.ascii_dots(h)), r"\.$", "")


def rules_table(spark: SparkSession, rules: list[str]) -> DataFrame:
    """Rule lines (``co.uk``, ``*.ck``, ``!www.ck``) -> ``(rule, kind)``."""
    return spark.createDataFrame([(r,) for r in rules], "line string").select(
        F.regexp_replace(F.col("line"), r"^(\*\.|!)", "").alias("rule"),
        F.when(F.col("line").startswith("!"), F.lit("exception"))
         .when(F.col("line").startswith("*."), F.lit("wildcard"))
         .otherwise(F.lit("normal")).alias("kind"))


def normalize_rules(rules_df: DataFrame) -> DataFrame:
    """Accept either raw lines in ``rule`` (with ``*.``/``!``) or ``(rule, kind)``."""
    cols = set(rules_df.columns)
    if "kind" in cols:
        line = F.col("rule")
        kind = F.col("kind")
        return rules_df.select(
            F.lower(idna.ascii_dots(F.regexp_replace(line, r"^(\*\.|!)", ""))).alias("rule"),
            F.when(line.startswith("!"), F.lit("exception"))
             .when(line.startswith("*."), F.lit("wildcard"))
             .otherwise(kind).alias("kind"))
    return rules_df.select(F.col("rule").alias("line")).select(
        F.lower(idna.ascii_dots(F.regexp_replace(F.col("line"), r"^(\*\.|!)", ""))).alias("rule"),
        F.when(F.col("line").startswith("!"), F.lit("exception"))
         .when(F.col("line").startswith("*."), F.lit("wildcard"))
         .otherwise(F.lit("normal")).alias("kind"))


def _in_unicode(rules: DataFrame) -> DataFrame:
    return rules.withColumn("rule", idna.host_to_unicode("rule"))


def _domains_by_candidate_join(hosts: DataFrame, rules_df: DataFrame, host_col: str, idn: bool = True) -> DataFrame:
    """Fallback for rule tables too large to broadcast: ``(host, sld)`` per distinct host.

    One row per candidate suffix joined to the rules (a shuffle join), then the
    prevailing match per host (an aggregate over at most one row per label).
    """
    rules = normalize_rules(rules_df)
    rules = _in_unicode(rules) if idn else rules

    h = hosts.select(F.col(host_col).alias("host")).where(F.col("host").isNotNull()).distinct()
    h = h.withColumn("__bare", bare_host("host")).withColumn("__labels", F.split("__bare", r"\."))
    h = h.withColumn("__keys", idna.unicode_labels(F.col("__labels"), F.col("__bare")) if idn else F.col("__labels"))
    n = F.size("__labels")
    cands = h.select(
        "host", "__bare", "__labels", "__keys",
        F.explode(F.sequence(F.lit(1), n)).alias("k"),
    ).withColumn("cand", F.array_join(F.slice("__keys", n - F.col("k") + 1, F.col("k")), "."))

    matched = cands.join(rules, cands["cand"] == rules["rule"], "left")
    k = F.col("k")
    per_host = matched.groupBy("host", "__bare", "__labels").agg(
        F.max(F.when(F.col("kind") == "exception", k - 1)).alias("exc_len"),
        F.max(F.when(F.col("kind") == "normal", k)
               .when((F.col("kind") == "wildcard") & (k + 1 <= n), k + 1)).alias("best_len"),
    )
    slen = F.coalesce(F.col("exc_len"), F.col("best_len"), F.lit(0))
    labels = F.col("__labels")
    suffix = F.when(slen == 0, F.lit("")).otherwise(
        F.array_join(F.slice(labels, n - slen + 1, slen), "."))
    domain = F.when(slen >= n, F.lit("")).otherwise(F.element_at(labels, n - slen))
    is_ip = F.col("__bare").rlike(IPV4_PATTERN)
    return per_host.select(
        "host",
        F.when(is_ip, F.concat(F.col("__bare"), F.lit(".")))
         .otherwise(F.concat(domain, F.lit("."), suffix)).alias("sld"),
    )


def registrable_domains(hosts: DataFrame, rules_df: DataFrame, host_col: str = "host") -> DataFrame:
    """``(host, sld)`` for every distinct non-null value of ``host_col``.

    ``host_col`` may hold a netloc; it is reduced with :func:`bare_host`.
    """
    h = hosts.select(F.col(host_col).alias("host")).where(F.col("host").isNotNull()).distinct()
    return with_registrable_domain(h, rules_df, "host", "sld").select("host", "sld")


def _rule_kinds(rules: DataFrame) -> DataFrame:
    """One row per rule text with flags for the kinds it has."""
    return rules.groupBy("rule").agg(
        F.max(F.col("kind") == "normal").alias("is_normal"),
        F.max(F.col("kind") == "wildcard").alias("is_wildcard"),
        F.max(F.col("kind") == "exception").alias("is_exception"))


def with_registrable_domain(df: DataFrame, rules_df: DataFrame, host_col: str,
                            out: str = "sld") -> DataFrame:
    """Add ``out`` (the registrable domain of ``host_col``) to every row of ``df``.

    Narrow: K broadcast lookups of the host's last 1..K labels.  Falls back to
    a per-distinct-host table joined back when the rules are too many to
    broadcast.
    """
    rules = normalize_rules(rules_df)
    # One small job: the rule lines (the broadcast bound), the most labels, any label in Punycode or beyond ASCII.
    stats = rules.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("rule", r"\."))).alias("k"),
                      F.max(F.col("rule").rlike(IDN_PATTERN)).alias("idn")).first()
    kinds = _rule_kinds(_in_unicode(rules) if stats["idn"] else rules)
    if stats["n"] > MAX_BROADCAST_RULES:  # not broadcastable: per distinct host, then join back
        doms = _domains_by_candidate_join(df, rules_df, host_col, stats["idn"]).select(
            F.col("host").alias("__wf_host"), F.col("sld").alias(out))
        return df.join(doms, df[host_col] == doms["__wf_host"], "left").drop("__wf_host")
    small = F.broadcast(kinds)
    k_max = stats["k"] or 1

    d = df.withColumn("__wf_bare", bare_host(F.col(host_col))) \
          .withColumn("__wf_labels", F.split("__wf_bare", r"\."))
    keys = "__wf_labels"
    if stats["idn"]:
        keys = "__wf_keys"
        d = d.withColumn(keys, idna.unicode_labels(F.col("__wf_labels"), F.col("__wf_bare")))
    n = F.size("__wf_labels")
    exc, best = [], []
    for k in range(1, k_max + 1):
        cand = F.when(n >= k, F.array_join(F.slice(keys, -k, k), "."))
        look = small.select(F.col("rule").alias(f"__wf_r{k}"), F.col("is_normal").alias(f"__wf_n{k}"),
                            F.col("is_wildcard").alias(f"__wf_w{k}"),
                            F.col("is_exception").alias(f"__wf_x{k}"))
        d = d.withColumn(f"__wf_c{k}", cand)
        d = d.join(look, d[f"__wf_c{k}"] == look[f"__wf_r{k}"], "left")
        exc.append(F.when(F.col(f"__wf_x{k}"), F.lit(k - 1)))
        best.append(F.when(F.col(f"__wf_n{k}"), F.lit(k)))
        best.append(F.when(F.col(f"__wf_w{k}") & (n >= k + 1), F.lit(k + 1)))
    top = (lambda cs: cs[0] if len(cs) == 1 else F.greatest(*cs))
    slen = F.coalesce(top(exc), top(best), F.lit(0))
    d = d.withColumn("__wf_slen", slen)
    labels, sl = F.col("__wf_labels"), F.col("__wf_slen")
    suffix = F.when(sl == 0, F.lit("")).otherwise(F.array_join(F.slice(labels, n - sl + 1, sl), "."))
    domain = F.when(sl >= n, F.lit("")).otherwise(F.element_at(labels, n - sl))
    is_ip = F.col("__wf_bare").rlike(IPV4_PATTERN)
    sld = F.when(F.col(host_col).isNull(), F.lit(None).cast("string")) \
        .when(is_ip, F.concat(F.col("__wf_bare"), F.lit("."))) \
        .otherwise(F.concat(domain, F.lit("."), suffix))
    helpers = [c for c in d.columns if c.startswith("__wf_")]
    return d.withColumn(out, sld).drop(*helpers)
