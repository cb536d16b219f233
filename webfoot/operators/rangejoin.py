"""Addresses in arbitrary ``lo..hi`` ranges (O41) as an equi-join on prefixes.

A range that is no CIDR block is cut into its minimal prefix cover: the fewest
aligned blocks that together hold exactly its addresses, at most two for each bit
but one.  On bit strings the cover can be read off the ends: below the first bit
where they differ, every 0 of ``lo`` has the sibling block with a 1 inside the
range, every 1 of ``hi`` the sibling with a 0, and the ends themselves stand for
the largest blocks that begin (end) there.  Blocks of one range are disjoint, so an
address meets a range once however many blocks it has, and overlapping ranges are
no special case: the join gives what ``BETWEEN`` gives, without comparing pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefixjoin import address_key


def range_cover(lo: Column, hi: Column) -> Column:
    """Prefixes of the minimal cover of ``lo..hi``, bit strings of one length; null unless ``lo <= hi``."""
    width = F.length(lo)
    positions = F.sequence(F.lit(1), width)
    at = lambda bits, i: F.substring(bits, i, F.lit(1))
    head = lambda bits, n: F.substring(bits, F.lit(1), n)
    # The first bit where the ends differ; behind the last bit for a single address.
    split = F.coalesce(F.array_min(F.filter(positions, lambda i: at(lo, i) != at(hi, i))), width + 1)

    def side(bits: Column, own: str, split: Column) -> Column:
        """The blocks below the split on the side of ``lo`` (``own`` is 0) or of ``hi`` (1)."""
        other = "1" if own == "0" else "0"
        last = F.greatest(F.coalesce(F.array_max(F.filter(positions, lambda i: at(bits, i) == other)), F.lit(0)), split)
        inner = F.filter(positions, lambda i: (i > split) & (i <= last) & (at(bits, i) == own))
        return F.concat(F.array(head(bits, last)), F.transform(inner, lambda i: F.concat(head(bits, i - 1), F.lit(other))))

    def cover(split: Column) -> Column:
        rest = F.substring(lo, split, width)
        whole = (~rest.contains("1")) & (~F.substring(hi, split, width).contains("0"))
        return F.when(whole, F.array(head(lo, split - 1))).otherwise(F.concat(side(lo, "0", split), side(hi, "1", split)))

    named = F.transform(F.array(split), cover)  # the split is worked out once
    return F.when((lo <= hi) & (F.length(hi) == width), F.get(named, 0))


def range_rows(ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """``ranges`` with ``__wf_family, __wf_len, __wf_key``, one row for each block of a range's cover.

    Ends that are no addresses, of two families or in the wrong order give no row.
    """
    ends = ranges.withColumn("__wf_lo", address_key(lo)).withColumn("__wf_hi", address_key(hi))
    same = F.col("__wf_lo.family") == F.col("__wf_hi.family")
    covered = ends.where(same).withColumn("__wf_key", F.explode(range_cover(F.col("__wf_lo.bits"), F.col("__wf_hi.bits"))))
    return covered.select(*ranges.columns, F.col("__wf_lo.family").alias("__wf_family"),
                          F.length("__wf_key").alias("__wf_len"), "__wf_key")


def in_ranges(points: DataFrame, ip: str, ranges: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Every pair of a distinct valid address of ``points`` and a range that holds it: ``ip`` and the range's columns.

    An address is probed once for each block length that occurs (33 or 129 at
    most); a popular block is split by the adaptive skew join.
    """
    blocks = range_rows(ranges, lo, hi)
    lengths = blocks.groupBy(F.col("__wf_family").alias("__wf_f")).agg(F.collect_set("__wf_len").alias("__wf_lens"))
    pts = points.select(F.col(ip).alias("__wf_ip")).distinct().withColumn("__wf_a", address_key("__wf_ip"))
    probes = pts.where(F.col("__wf_a").isNotNull()).join(  # two rows at most
        F.broadcast(lengths), F.col("__wf_a.family") == F.col("__wf_f")).select(
        "__wf_ip", F.col("__wf_a.family").alias("__wf_family"), F.col("__wf_a.bits").alias("__wf_bits"),
        F.explode("__wf_lens").alias("__wf_len"))
    probes = probes.withColumn("__wf_key", F.col("__wf_bits").substr(F.lit(1), F.col("__wf_len"))).drop("__wf_bits")
    return probes.join(blocks, ["__wf_family", "__wf_len", "__wf_key"]).select(
        F.col("__wf_ip").alias(ip), *[F.col(c) for c in ranges.columns if c != ip])
