"""Seen checks and de-duplication.

A key is "seen" when its md5 digest is in the store of that name (URL, DNS,
WHOIS and IP records are separate stores of one table).  The checks are joins
on the digest, planned by Catalyst (shuffle hash / sort-merge, or broadcast when
AQE measures one side as small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINEL = "done"


def drop_sentinel(df: DataFrame, col: str) -> DataFrame:
    """Remove the end-of-input marker (nulls are kept)."""
    return df.where(~F.col(col).eqNullSafe(F.lit(SENTINEL)))


def with_digest(df: DataFrame, key_col: str, out: str = "key_md5") -> DataFrame:
    return df.withColumn(out, F.md5(F.col(key_col).cast("string")))


def _digests(store: DataFrame, name: str) -> DataFrame:
    return store.where(F.col("store") == name).select(F.col("key_md5").alias("__wf_md5"))


def unseen(candidates: DataFrame, store: DataFrame, key_col: str, name: str) -> DataFrame:
    """Candidates whose key digest is not in the store ``name`` (left anti-join)."""
    c = with_digest(candidates, key_col, "__wf_md5")
    s = _digests(store, name)
    return c.join(s, "__wf_md5", "left_anti").drop("__wf_md5")


def already_seen(candidates: DataFrame, store: DataFrame, key_col: str, name: str) -> DataFrame:
    """The "have done" report: candidates already in the store ``name`` (left semi-join)."""
    c = with_digest(candidates, key_col, "__wf_md5")
    s = _digests(store, name)
    return c.join(s, "__wf_md5", "left_semi").drop("__wf_md5")


def first_arrival(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``, the one with the lowest ``order`` (a total order).

    An aggregate (``min_by``) rather than a window: it combines on the map side,
    so a key that arrives very often is reduced before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    packed = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.struct(*order)).alias("__wf_first"))
    return packed.select(key, *[F.col("__wf_first." + c).alias(c) for c in others])


def seen_union(*frames: DataFrame) -> DataFrame:
    """Union-distinct of key sets."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()
