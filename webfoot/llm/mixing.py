"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a keyed pseudo-random order, form blocks of a fixed
number.  On one line of slots block ``i`` (from 1) of a source of weight ``w``
is released at slot ``floor((i - 1) / w)`` and due before ``ceil(i / w)``; in
each slot the released block with the earliest deadline is emitted.  Every
block meets its window, so after any number of slots a source is less than one
block away from its target weight.  Weights are whole parts of about ``SCALE``,
so windows are exact however far the line goes.

The line is cut into cycles of ``period`` slots that are scheduled side by
side.  What each source has had at a cut is derived from the weights alone: it
is the rounded down target, or one more for the sources that must go ahead.
Those are found by a walk over the ``period`` slots before the cut: whenever
more blocks wait than the slots up to the cut can take later, the waiting block
with the earliest deadline is put before the cut.  With such a state at both
ends every cycle can meet all windows, so earliest deadline first does, and the
cycles join to one Pfair line without any state handed from one to the next.

Sources too small for a slot in each cycle form groups, which are dealt slots
like sources and deal them to their members in the same way, so no weight is
lifted; a member is bounded as above within its group's line (less than two
blocks from its own), and its release time and deadline are those of the
group's block.  Only cycles that can hold a block are scheduled.  When a source
has no block left its slots stay empty; the others keep their proportions, and
every document is emitted exactly once.

Only DataFrame functions are used.  A document's number in its source comes
from ranks within (source, hash range) plus the counts of the ranges before
it: a source with a third of all rows is spread over as many ranges as it
needs, and no task sorts more than one range.  Blocks find their slots by an
equi-join of one row a block, and reach the documents as one array a range, so
documents are shuffled once.  The source table, one short row a source, is made
on the driver; it is broadcast up to ``BROADCAST_SOURCES`` rows and joined by
shuffles beyond.  More than ``MAX_CHILDREN`` sources are scheduled in groups.

Defined cases: rows with a null source form a source of their own; rows with a
null id are spread by a digest of the whole row; equal ids follow each other,
in the order of that digest (equal rows are interchangeable, columns that hold
maps or variants are left out of it); a source without a given weight gets
``default_weight``; weights of absent sources are ignored; a weight below half
a part counts as one part; an empty table gives an empty result; columns with
the name of an added column are replaced, any other name is allowed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfoot.llm.common import col, materialize, without
from webfoot.llm.pii import let

BLOCK_DOCS = 16
PERIOD = 1024
MAX_CHILDREN = 512  # sources scheduled together; more are put into groups
RANGE_ROWS = 20_000  # rows of a hash range, about
SCALE = 1 << 30  # parts that the weights of a node are cut into, about
BROADCAST_SOURCES = 50_000  # rows of some 100 bytes
SEED = "mix-1"
NO_SOURCE = "\u0000"
ADDED = ["mix_block", "mix_place", "mix_release", "mix_deadline", "mix_slot"]


def parts_of(weights: list[float]) -> list[int]:
    """Weights as whole parts of about ``SCALE``."""
    total = sum(weights)
    return [max(1, round(w / total * SCALE)) for w in weights]


def groups(weights: dict[str, float], period: int = PERIOD) -> tuple[dict[str, list], list[tuple]]:
    """Each source's ``(node, child, part, total)`` from its group up to the root, and ``(node, parts, total)``.

    All children of a node get a slot in each cycle or more, but for one at most.
    """
    paths, nodes = {s: [] for s in weights}, []

    def build(members: list[str]) -> None:
        total = sum(weights[s] for s in members)
        parts = period if len(members) <= MAX_CHILDREN else min(period, MAX_CHILDREN // 2)
        enough = lambda w: parts * w / total >= 1
        children, bundles, held, weight = [[s] for s in members if enough(weights[s])], [], [], 0.0
        for s in members:
            if not enough(weights[s]):
                held.append(s)
                weight += weights[s]
                if enough(weight):
                    bundles.append(held)
                    held, weight = [], 0.0
        if held and bundles:
            bundles[-1] += held
            held = []
        children = sorted(children + bundles + [held] * bool(held))
        node, dealt = len(nodes), parts_of([sum(weights[s] for s in c) for c in children])
        nodes.append((node, dealt, sum(dealt)))
        for child in children:
            if len(child) > 1:
                build(child)
        for i, child in enumerate(children):
            for s in child:
                paths[s].append((node, i, dealt[i], sum(dealt)))

    build(sorted(weights))
    return paths, nodes


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _up(a: Column, b: Column) -> Column:
    """The quotient rounded up."""
    return _div(a + b - 1, b)


def release(number: Column, part: Column, total: Column) -> Column:
    """The first slot of block ``number`` (from 0)."""
    return _div(number * total, part)


def deadline(number: Column, part: Column, total: Column) -> Column:
    """The slot that block ``number`` must come before."""
    return _up((number + 1) * total, part)


def blocks_at(cut: Column, parts: Column, total: Column, period: int) -> Column:
    """The blocks that each child has had when ``cut`` slots are dealt; they sum to the cut."""
    had = lambda p: _div(p * cut, total)
    over = lambda p: (p * cut) % total != 0
    waiting = F.array_sort(F.filter(F.transform(parts, lambda p, i: F.when(over(p), F.struct(
        deadline(had(p), p, total).alias("deadline"), i.alias("i"), release(had(p), p, total).alias("release")))),
        lambda x: x.isNotNull()))

    def step(rest: Column, slot: Column) -> Column:
        # Blocks released before the slot, less the slots before it, may stay behind the cut.
        behind = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + _up(p * slot, total)) - slot
        return let(F.filter(rest, lambda x: x["release"] < slot), lambda ready: F.when(F.size(ready) == 0, rest).when(
            F.size(ready) > behind, F.filter(rest, lambda x: x["i"] != F.get(ready, F.lit(0))["i"])).otherwise(rest))

    # A child with a slot in each cycle waits no longer than this; a smaller one is never forced ahead before it.
    walk = F.sequence(F.greatest(cut - period - 2, F.lit(0).cast("long")) + 1, cut)
    return let(F.aggregate(walk, waiting, step), lambda rest: F.transform(parts, lambda p, i: had(p) + F.when(
        over(p) & ~F.exists(rest, lambda x: x["i"] == i), 1).otherwise(0)))


def cycle_table(cycles: DataFrame, period: int) -> DataFrame:
    """``(node, child, number, release, deadline, slot)`` for ``(node, parts, total, cycle)``, earliest deadline first."""
    parts, total, begin = F.col("parts"), F.col("total"), F.col("cycle") * period

    def waiting(s: Column, part: Column, number: Column, end: Column) -> Column:
        return F.struct(deadline(number, part, total).alias("deadline"), s.alias("s"), number.alias("number"),
                        release(number, part, total).alias("release"), part.alias("part"), end.alias("end"))

    def emit(state: Column, slot: Column) -> Column:
        ready = F.filter(state["next"], lambda x: (x["number"] < x["end"]) & (x["release"] <= slot))
        return let(F.array_min(ready), lambda first: F.struct(
            F.transform(state["next"], lambda x: F.when(
                x["s"] == first["s"], waiting(x["s"], x["part"], x["number"] + 1, x["end"])).otherwise(x)).alias("next"),
            F.concat(state["order"], F.array(first)).alias("order")))

    one = "struct<deadline:bigint,s:int,number:bigint,release:bigint,part:bigint,end:bigint>"
    ends = let(blocks_at(begin + period, parts, total, period), lambda after: F.zip_with(
        blocks_at(begin, parts, total, period), after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    first = let(ends, lambda ends: F.struct(
        F.transform(parts, lambda p, i: waiting(i, p, F.get(ends, i)["a"], F.get(ends, i)["b"])).cast(
            f"array<{one}>").alias("next"), F.array().cast(f"array<{one}>").alias("order")))
    order = F.aggregate(F.sequence(begin, begin + period - 1), first, emit, lambda state: state["order"])
    return (cycles.select("node", begin.alias("begin"), F.posexplode(order).alias("in_slot", "e"))
            .select("node", F.col("e.s").alias("child"), F.col("e.number").alias("number"), F.col("e.release").alias("release"),
                    F.col("e.deadline").alias("deadline"), (F.col("begin") + F.col("in_slot")).alias("slot")))


def scheduled(blocks: DataFrame, known: DataFrame, depth: int, period: int) -> DataFrame:
    """``blocks`` (with ``block`` and the ``path`` of their source) with ``release, deadline, slot``."""
    spark, kept = blocks.sparkSession, blocks.columns
    number, part, total = F.col("number"), F.col("part"), F.col("total")
    rest, out = blocks.withColumn("slot", F.col("block")), []
    for level in range(depth):  # groups within groups: one level for all but the smallest weights
        here = rest.drop("release", "deadline").withColumnRenamed("slot", "number").select(
            "*", *[F.col("path")[level][c].alias(c) for c in ("node", "child", "part", "total")])
        if level:
            here = materialize(here, "blocks")
        # A block's cycle is one that its window meets; of a long window only the last ones are used.
        last = deadline(number, part, total) - 1
        low = _div(F.greatest(release(number, part, total), last - 2 * period - 4), F.lit(period))
        cycles = (here.select("node", F.explode(F.sequence(low, _div(last, F.lit(period)))).alias("cycle"))
                  .distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.hash("node", "cycle")))
        placed = here.join(cycle_table(cycles.join(known, "node"), period), ["node", "child", "number"], "left").select(
            *kept, "release", "deadline", "slot")
        out.append(placed.where(F.size("path") == level + 1) if depth > 1 else placed)
        rest = placed.where(F.size("path") > level + 1)
    return reduce(DataFrame.unionByName, out)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source", id_col: str = "doc_id",
        block_docs: int = BLOCK_DOCS, period: int = PERIOD, default_weight: float = 1.0, temperature: float = 0.5,
        seed: str = SEED) -> DataFrame:
    """``docs`` with ``mix_block, mix_place, mix_release, mix_deadline, mix_slot``.

    Without ``weights`` a source weighs its number of documents to the power
    ``temperature``.  ``mix_slot`` orders the mixture; ``mix_place`` orders
    the documents of a block.
    """
    spark = docs.sparkSession
    source = F.coalesce(col(source_col).cast("string"), F.lit(NO_SOURCE))
    counted = docs.groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.count(col(id_col)).alias("ids")).collect()
    sizes, without_id = {r["s"]: r["n"] for r in counted}, any(r["ids"] < r["n"] for r in counted)
    kept = without(docs, ADDED)
    if not sizes:
        return docs.select(*map(col, kept)).withColumns({c: F.lit(0).cast("long") for c in ADDED})
    given = {s: (n ** temperature if weights is None else weights.get(s, default_weight)) for s, n in sizes.items()}
    if min(given.values()) <= 0:
        raise ValueError("weights must be positive")
    period *= -(-4 // period)  # groups need a few slots to share
    paths, nodes = groups(given, period)
    small = F.broadcast if len(sizes) <= BROADCAST_SOURCES else lambda df: df
    table = spark.createDataFrame(  # one row a source
        [(s, paths[s], math.ceil(n / RANGE_ROWS)) for s, n in sizes.items()],
        "_wf_s string, path array<struct<node:int,child:int,part:long,total:long>>, _wf_ranges long")
    known = spark.createDataFrame(nodes, "node int, parts array<long>, total long")

    row_digest = F.xxhash64(*[col(f.name) for f in docs.schema if not any(
        t in f.dataType.simpleString() for t in ("map<", "variant"))])
    # The digest's order is that of its first eight digits where these differ, so ranges of them are ranges of it.
    # Only a table with null ids is read whole to number its rows.
    unnamed = F.concat_ws(":", F.lit("null"), row_digest.cast("string")) if without_id else F.lit("null")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(col(id_col).cast("string"), unnamed)))
    # The caller's columns travel as one struct, so that no name clashes with those made here.
    ranked = (docs.select(F.struct(*map(col, kept)).alias("_wf_row"), source.alias("_wf_s"), key.alias("_wf_key"),
                          col(id_col).alias("_wf_id"), row_digest.alias("_wf_digest"))
              .join(small(table.drop("path")), "_wf_s")
              .withColumn("_wf_range", F.floor(F.conv(F.substring("_wf_key", 1, 8), 16, 10).cast("double")
                                               / 4294967296.0 * F.col("_wf_ranges"))))
    within = Window.partitionBy("_wf_s", "_wf_range").orderBy("_wf_key", "_wf_id", "_wf_digest")
    before = Window.partitionBy("_wf_s").orderBy("_wf_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for RANGE_ROWS documents, and one for each block of those.
    offsets = materialize(ranked.groupBy("_wf_s", "_wf_range").agg(F.count(F.lit(1)).alias("n")).select(
        "_wf_s", "_wf_range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_wf_before")), "ranges")
    first = F.floor(F.col("_wf_before") / block_docs)
    blocks = offsets.join(small(table.drop("_wf_ranges")), "_wf_s").select("_wf_s", "_wf_range", "path", F.explode(
        F.sequence(first, F.floor((F.col("_wf_before") + F.col("n") - 1) / block_docs))).alias("block"))
    slots = (scheduled(blocks, small(known), max(map(len, paths.values())), period).groupBy("_wf_s", "_wf_range").agg(
        F.array_sort(F.collect_list(F.struct("block", "release", "deadline", "slot"))).alias("_wf_slots")))
    # Both sides lie by (source, range): documents are not shuffled again.
    numbered = (ranked.withColumn("_wf_n", F.row_number().over(within))
                .join(offsets.join(slots, ["_wf_s", "_wf_range"]), ["_wf_s", "_wf_range"])
                .withColumn("_wf_at", F.col("_wf_before") + F.col("_wf_n") - 1)
                .withColumn("mix_block", F.floor(F.col("_wf_at") / block_docs))
                .withColumn("mix_place", F.col("_wf_at") % block_docs)
                .withColumn("_wf_slot", F.get("_wf_slots", (F.col("mix_block") - first).cast("int"))))
    return numbered.select(*[F.col("_wf_row").getField(c).alias(c) for c in kept], "mix_block", "mix_place", *[
        F.col(f"_wf_slot.{c}").alias(f"mix_{c}") for c in ("release", "deadline", "slot")])


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture's rows in emission order, without the added columns."""
    return mixed.orderBy("mix_slot", "mix_place").drop(*ADDED)
