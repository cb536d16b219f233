"""Longest-prefix match of addresses to CIDR blocks as an exact equi-join.

An address (IPv4 or IPv6) becomes a string of its bits.  A block
``network/len`` is keyed by ``(family, len, first len bits)``.  Each address
emits one probe per prefix length that occurs among the blocks of its family
(a bounded list: at most 33 IPv4 and 129 IPv6 lengths), so matching is an
equality join with no range condition and no nested loop, and no block is
ever exploded into many rows.  The most specific block per address is a
``max_by`` aggregate.

Addresses are parsed once each (they are made distinct first).  Nothing is
forced to broadcast and no job runs while the plan is made: the prefix
lengths are a two-row table, and Spark chooses the join from real sizes and
splits a probe key that many addresses share (say, one /8 holding a third).

An IPv6 address may end in a dotted IPv4 tail (``::ffff:10.0.0.1``).  Blocks
with a malformed network or length match nothing; :func:`bad_blocks` lists them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|0[0-9]{1,2})"
IPV4_DOTTED = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
IPV4_TAIL = rf"^(.*:)({OCTET}(?:\.{OCTET}){{3}})$"
IPV6_CHARS = r"^[0-9a-f:]+$"
HEX_GROUP = r"^[0-9a-f]{1,4}$"
# --- end of fixed values ---


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` in the plan once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def ipv4_bits(ip) -> Column:
    """32-character bit string of a dotted IPv4 address, null if invalid."""
    ip = _c(ip)
    return F.when(ip.rlike(IPV4_DOTTED), F.array_join(F.transform(
        F.split(ip, r"\."), lambda o: F.lpad(F.bin(o.cast("bigint")), 8, "0")), ""))


def _hex_tail(ip: Column) -> Column:
    """A dotted tail as two hexadecimal groups."""
    def convert(x: Column) -> Column:
        octets = F.transform(F.split(F.regexp_extract(x, IPV4_TAIL, 2), r"\."),
                             lambda o: F.lpad(F.hex(o.cast("bigint")), 2, "0"))
        return F.concat(F.regexp_extract(x, IPV4_TAIL, 1), F.array_join(F.slice(octets, 1, 2), ""), F.lit(":"),
                        F.lower(F.array_join(F.slice(octets, 3, 2), "")))
    return _let(ip, lambda x: F.when(x.rlike(IPV4_TAIL), F.lower(convert(x))).otherwise(x))


def ipv6_bits(ip) -> Column:
    """128-character bit string of an IPv6 address (lower case), null if invalid."""
    none = F.array().cast("array<string>")
    side = lambda s: F.when(F.coalesce(s, F.lit("")) == "", none).otherwise(F.split(s, ":"))

    def groups(x: Column) -> Column:
        def fill(parts: Column) -> Column:
            head, tail = side(F.get(parts, 0)), side(F.get(parts, 1))
            missing = F.lit(8) - F.size(head) - F.size(tail)
            return (F.when((F.size(parts) == 2) & (missing >= 1), F.concat(head, F.array_repeat(F.lit("0"), missing), tail))
                    .when(F.size(parts) == 1, F.split(x, ":")))
        return _let(F.split(x, "::", -1), fill)

    def bits(g: Column) -> Column:
        return F.when((F.size(g) == 8) & F.forall(g, lambda x: x.rlike(HEX_GROUP)), F.array_join(
            F.transform(g, lambda x: F.lpad(F.conv(x, 16, 2), 16, "0")), ""))

    return _let(_hex_tail(_c(ip)), lambda x: F.when(
        x.rlike(IPV6_CHARS) & x.contains(":"), _let(groups(x), bits)))


def address_key(ip) -> Column:
    """``struct(family, bits)`` of an address, null if it is none."""
    return _let(F.lower(_c(ip)), lambda x: _let(ipv4_bits(x), lambda v4: F.when(
        v4.isNotNull(), F.struct(F.lit(4).alias("family"), v4.alias("bits"))).otherwise(
        _let(ipv6_bits(x), lambda v6: F.when(v6.isNotNull(), F.struct(F.lit(6).alias("family"), v6.alias("bits")))))))


def _keyed(blocks: DataFrame, cidr: str) -> DataFrame:
    parts = F.split(F.col(cidr), "/")
    return (blocks.withColumn("__wf_k", address_key(F.get(parts, 0)))
            .withColumn("__wf_len", F.get(parts, 1).try_cast("int"))
            .withColumn("__wf_key", F.when(F.col("__wf_len").between(0, F.length("__wf_k.bits")),
                                           F.col("__wf_k.bits").substr(F.lit(1), F.col("__wf_len")))))


def bad_blocks(blocks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """The blocks whose network or length is malformed."""
    return _keyed(blocks, cidr).where("__wf_key is null").select(*blocks.columns)


def block_keys(blocks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Well-formed blocks with ``__wf_family``, ``__wf_len`` and ``__wf_key`` (first len bits of the network)."""
    return _keyed(blocks, cidr).where(F.col("__wf_key").isNotNull()).select(
        *blocks.columns, F.col("__wf_k.family").alias("__wf_family"), "__wf_len", "__wf_key")


def longest_prefix_match(points: DataFrame, ip: str, blocks: DataFrame, info: list[str],
                         cidr: str = "cidr") -> DataFrame:
    """Every distinct valid address of ``points`` with its most specific block's ``info``.

    Output: ``ip``, ``__wf_match`` (struct of ``cidr`` and ``info``, null if no block).
    """
    b = block_keys(blocks.select(cidr, *info), cidr)
    # Two families with at most 33 and 129 lengths.
    lengths = b.groupBy(F.col("__wf_family").alias("__wf_f")).agg(F.collect_set("__wf_len").alias("__wf_lens"))
    pts = points.select(F.col(ip).alias("ip")).where(F.col("ip").isNotNull()).distinct()
    pts = pts.withColumn("__wf_a", address_key("ip")).where(F.col("__wf_a").isNotNull())
    probes = pts.join(F.broadcast(lengths), F.col("__wf_a.family") == F.col("__wf_f"), "left").select(
        "ip", F.col("__wf_a.family").alias("__wf_family"), F.col("__wf_a.bits").alias("__wf_bits"),
        F.explode_outer("__wf_lens").alias("__wf_len"))
    probes = probes.withColumn("__wf_key", F.col("__wf_bits").substr(F.lit(1), F.col("__wf_len")))
    hits = probes.join(b, ["__wf_family", "__wf_len", "__wf_key"], "left")
    matched = F.when(F.col(cidr).isNotNull(), F.struct(F.col(cidr).alias("cidr"), *[F.col(c) for c in info]))
    # Of two blocks with the same prefix the one whose fields come last in order wins.
    order = F.when(F.col(cidr).isNotNull(), F.struct("__wf_len", cidr, *info))
    return hits.groupBy("ip").agg(F.max_by(matched, order)
                                  .alias("__wf_match"))
