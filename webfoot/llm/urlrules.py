"""URL filters: hashed host-suffix / path-prefix expressions against a rule table.

Each distinct (host, leading path) pair is expanded into every host suffix and
every path prefix that ends with a slash.  An expression meets a rule by an
equi-join on a short prefix of its SHA-256 digest; the full digest, the rest
of the rule's path and the rule precedence (longest first) are checked after
that.  Only DataFrame functions are used.

Scale: a verdict depends on the host and on as many characters of the path as
the longest rule has, so these pairs are made distinct (with partial
aggregation) before anything is expanded, and a host or page that holds a
third of all rows costs one expanded pair.  Suffixes with more labels than any
rule's host, and prefixes with more slashes than any rule's path, cannot match
and are not made.  The verdicts join back on the pair: an ordinary equi-join,
which Spark broadcasts only when it is small and splits when it is skewed.

Defined cases: a null url, or one without ``://``, has empty host and path and
gets the default verdict; null rules are ignored; of rules with equal text a
block wins; an empty host in a rule fits nothing; repeated rows are judged
alike; nulls in other columns pass through; input columns with the name of an
output column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webfoot.llm.common import col, lower_az, without

PREFIX_HEX = 8  # four bytes of the digest
OUTPUT = ["host", "path", "rule", "verdict"]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_az(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as ``(verdict, host, path)``."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules keyed by the digest of their host and of their path up to its last slash."""
    host, path = lower_az(F.col("host")), F.col("path")
    stem = F.regexp_extract(path, r"^([\s\S]*/)", 1)
    return (rules.where("verdict is not null and host is not null and path is not null and host <> ''")
            .select("verdict", host.alias("r_host"), path.alias("r_path"),
                    F.concat(host, path).alias("rule"), _expression(host, stem).alias("r_digest"))
            .groupBy("r_host", "r_path", "rule", "r_digest")
            .agg(F.max("verdict").alias("r_verdict"))  # 'block' sorts after 'allow'
            .withColumn("short", F.substring("r_digest", 1, PREFIX_HEX)))


def expand(pairs: DataFrame, max_labels: Column, max_slashes: Column) -> DataFrame:
    """Rows ``(u_host, u_head, digest, short)``, one per host suffix and path prefix.

    ``max_labels`` and ``max_slashes`` are what the rules need at most.
    """
    labels = F.split("u_host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n, max_labels)),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    parts = F.split("u_head", "/")
    slashes = F.size(parts) - 1
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(slashes, max_slashes)),
        lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"),
                           F.when(k > 0, F.lit("/")).otherwise(F.lit(""))))
    return (pairs.where("u_host <> ''")
            .withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
            .withColumn("digest", _expression(F.col("suffix"), F.col("prefix")))
            .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
            .select("u_host", "u_head", "digest", "short"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
          keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with ``host``, ``path``, ``rule`` and ``verdict``."""
    ready = prepare_rules(rules)
    # One row of bounds; an empty rule table gives zeros, so nothing is expanded beyond the root.
    need = ready.agg(
        F.coalesce(F.max(F.size(F.split("r_host", r"\."))), F.lit(1)),
        F.coalesce(F.max(F.size(F.split("r_path", "/")) - 1), F.lit(0)),
        F.coalesce(F.max(F.length("r_path")), F.lit(0))).first()
    labels, slashes, chars = F.lit(need[0]), F.lit(need[1]), need[2]

    kept = without(pages if keep is None else pages.select(*map(col, keep)), OUTPUT)
    url = col(url_col).cast("string")
    # The caller's columns travel as one struct, so that no name clashes with those made here.
    judged = pages.select(
        F.struct(F.lit(0).alias("any"), *[col(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias("_wf_row"),
        F.coalesce(url_host(url), F.lit("")).alias("host"),
        F.coalesce(url_path(url), F.lit("")).alias("path"))
    head = F.substring("path", 1, chars) if chars else F.lit("")
    pairs = judged.select(F.col("host").alias("u_host"), head.alias("u_head")).distinct()

    hits = (expand(pairs, labels, slashes).join(ready, "short")
            .where((F.col("digest") == F.col("r_digest")) & F.expr("startswith(u_head, r_path)"))
            .groupBy("u_host", "u_head")
            .agg(F.max_by(F.struct("rule", "r_verdict"), F.struct(
                F.length("rule"), F.length("r_host"), F.col("r_verdict"), F.col("rule"))).alias("won")))
    won = hits.select("u_host", "u_head", "won.rule", F.col("won.r_verdict").alias("won_verdict"))
    joined = judged.withColumn("_wf_head", head).join(
        won, (F.col("host") == F.col("u_host")) & (F.col("_wf_head") == F.col("u_head")), "left")
    return joined.select(*[F.col(f"_wf_row.c{i}").alias(c) for i, c in enumerate(kept)], "host", "path", "rule",
                         F.coalesce("won_verdict", F.lit(default)).alias("verdict"))
