"""Scans of the captured tables (parquet), one function per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SCAN_PARTITIONS = "webfoot.scan.partitions"


def _spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan to as many partitions as the caller asks for, if the caller asks.

    ``webfoot.scan.partitions`` is unset by default: a scan keeps its splits
    and nothing is shuffled.  A caller who knows that a table is one small
    file can set it, so that the CPU-heavy stage after the scan uses all cores.
    """
    wanted = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted and not df.isStreaming else df


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it.

    ``spread`` marks tables whose next stage is CPU-heavy per row (HTML
    scanning of ``pages``, edge building from ``lineitem``); see ``_spread``.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _spread(df) if spread else df


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages ``(page_id, url, html)``: the re-aimed page capture."""
    return table(spark, sf_dir, "pages", spread=True).select("page_id", "url", "html")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", spread=True)


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation")
