"""Seed sources (O1, O2, O3a-c, O9).

Two seed file shapes: a headerless positional CSV whose third field is a
host, and a CSV with a header holding ``host`` and ``ip``.  Both are read
with an explicit schema (no inference).  For the registered queries the
seed files are written by Spark from the captured tables into the shared
checkpoint folder and then read back through these same readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import scratch_path

# --- fixed values: whitespace Python's str.strip() removes (Unicode spaces and \x1c-\x1f) ---
PY_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# --- end of fixed values ---


def parse_positional(lines: DataFrame) -> DataFrame:
    """O1 + O9: line -> ``(url, host)``; the line is trimmed, fields are not.

    A line with fewer than three fields raises under ANSI mode, as the
    reference does.
    """
    stripped = F.regexp_replace(F.col("value"), PY_STRIP, "")
    host = F.split(stripped, ",").getItem(2)
    return lines.select(U.https_prefix(host).alias("url"), host.alias("host"))


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """O1: headerless positional CSV read as text lines."""
    return parse_positional(spark.read.text(path))


def read_header(spark: SparkSession, path: str) -> DataFrame:
    """O2 + O9: header CSV with ``host`` and ``ip`` -> ``(url, host, ip)``.

    Columns are found by header name in any order (others are ignored); no
    type inference, every value is read as text.
    """
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(U.http_prefix("host").alias("url"), "host", "ip")


def url_seeds(urls: DataFrame, url: str = "url") -> DataFrame:
    """Seed URLs with no referrer."""
    return urls.select(F.col(url).alias("url"), F.lit(None).cast("string").alias("pre_url"))


def host_seeds(df: DataFrame, host: str = "host") -> DataFrame:
    """Single-column seed hosts for DNS and WHOIS."""
    return df.select(F.col(host).alias("fqdn")).where(F.col("fqdn").isNotNull())


def ip_seeds(df: DataFrame) -> DataFrame:
    """``(ip, fqdn)`` pairs zipped from the ``ip`` and ``host`` columns."""
    return df.select("ip", F.col("host").alias("fqdn"))


def write_positional(spark: SparkSession, pages: DataFrame) -> str:
    """Write ``page_id,page,host`` lines, one per page."""
    path = scratch_path(spark, "seeds_positional")
    lines = pages.select(F.concat_ws(",", F.col("page_id").cast("string"), F.lit("page"),
                                     U.url_host("url")).alias("value"))
    lines.write.mode("errorifexists").text(path)
    return path


def write_header(spark: SparkSession, host_ip: DataFrame) -> str:
    """Write a ``host,ip`` CSV with a header line."""
    path = scratch_path(spark, "seeds_header")
    host_ip.select("host", "ip").write.mode("errorifexists").option("header", True).csv(path)
    return path
