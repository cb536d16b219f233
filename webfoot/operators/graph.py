"""Link graph work.

The traversal (O57) is a driver loop of DataFrame levels over tables written
in the shared folder (each write cuts lineage and survives executor loss):

* edges are written once, then again bucketed by ``(src, salt)``.  ``salt`` is
  0 except for hub nodes, whose edges are spread by a hash of ``dst`` over as
  many salts as their degree needs, so no task holds more than about
  ``edges_per_task`` edges of one node;
* every level is written once, as one partition folder of the result.

Per level the frontier is expanded to ``(src, salt)``, joined to the bucketed
edges (a small frontier is broadcast, a large one is shuffled to the buckets;
the edges never move) and reduced to the lowest parent per node, map-side
first.  Nodes seen before go: the seen nodes are kept as a few runs that are
merged at doubling sizes, so the plan has a logarithmic number of scans
however many levels there are.  A level of checked size meets them by a
broadcast of the level, so that the seen nodes are not shuffled; a larger one
by a shuffled anti-join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import cut_lineage, scratch_path

# --- fixed values: traversal defaults ---
EDGES_PER_TASK = 2_000_000  # about 100 MB of edge rows
HUB_DEGREE = EDGES_PER_TASK  # out-degree above which a node's edges are salted
MAX_BUCKETS = 100_000  # Spark's limit; beyond it a bucket holds more edges and its sort spills
PAGE_REFERRERS = 1_000  # referrers of a target that one page of its list holds
CUT_DIGITS = 4  # leading digest digits by which a target's referrers are spread: 65,536 cuts
BROADCAST_LEVEL = 100_000  # rows of a level that are broadcast: some 10 MB
# --- end of fixed values ---


def links_to_hosts(edges: DataFrame, dst: str = "dst") -> DataFrame:
    """Distinct non-empty hosts of link targets (targets for DNS)."""
    return edges.select(U.url_host(dst).alias("fqdn")).where(F.col("fqdn") != "").distinct()


def inlinks(edges: DataFrame) -> DataFrame:
    """Per target, the number of distinct linking pages and the first one.

    Counted from distinct (dst, src) pairs: the pair shuffle spreads a very
    popular target over many tasks, and the count then combines map-side.
    The whole list is cut into pages by :func:`referrer_pages`.
    """
    pairs = edges.select("dst", "src").distinct()
    return pairs.groupBy("dst").agg(
        F.count("src").alias("n_inlinks"),
        F.min("src").alias("first_referrer"),
    )


def referrer_pages(edges: DataFrame, page_size: int = PAGE_REFERRERS) -> DataFrame:
    """The whole referrer list of every target, as numbered pages ``(dst, page, n, srcs)``.

    A target's referrers are ordered by ``(md5(src), src)``; page ``p`` holds
    the places ``p * page_size`` up to the next page (``n`` of them).  The order is
    cut by the leading digits of the digest, so the places come from counts per
    ``(dst, cut)`` and a row number inside the cut: a target that has a third
    of all links is spread over as many tasks as there are cuts, and
    no list is longer than a page.  The edges are written once, since both the
    counts and the numbering read them and would else extract them twice;
    they are moved once to their cuts (distinct, count and numbering share
    that partitioning) and once to their pages.  Rows with a null ``dst`` or
    ``src`` are no links.
    """
    digest = F.md5("src")
    edges = cut_lineage(edges.where("dst is not null and src is not null").select("dst", "src"))
    cut = edges.select(
        "dst", "src", F.substring(digest, 1, CUT_DIGITS).alias("__wf_cut")).repartition("dst", "__wf_cut") \
        .dropDuplicates(["dst", "__wf_cut", "src"])
    counts = cut.groupBy("dst", "__wf_cut").agg(F.count(F.lit(1)).alias("__wf_n"))
    before = F.sum("__wf_n").over(Window.partitionBy("dst").orderBy("__wf_cut").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("dst", "__wf_cut", F.coalesce(before, F.lit(0)).alias("__wf_start"))
    place = F.row_number().over(Window.partitionBy("dst", "__wf_cut").orderBy(digest, "src")) - 1
    placed = cut.withColumn("__wf_place", place).join(starts, ["dst", "__wf_cut"]).select(
        "dst", "src", (F.col("__wf_start") + F.col("__wf_place")).alias("__wf_place"))
    pages = placed.groupBy("dst", F.floor(F.col("__wf_place") / page_size).alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("__wf_place", "src"))).alias("__wf_rows"))
    return pages.select("dst", "page", "n", F.transform("__wf_rows", lambda r: r.src).alias("srcs"))


def with_referrers(records: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """Records whose ``pre_url`` is the first page of their referrers; without any it stays as it is."""
    first = pages.where("page = 0").select(F.col("dst").alias(url), F.col("srcs").alias("__wf_srcs"))
    return records.join(first, url, "left").withColumn(
        "pre_url", F.coalesce("__wf_srcs", "pre_url")).select(*records.columns)


def _bucketed_edges(edges: DataFrame, hubs: DataFrame, n_edges: int, edges_per_task: int) -> tuple[DataFrame, str]:
    """The salted edges as an external table bucketed by ``(src, salt)``, and the table's name."""
    spark = edges.sparkSession
    buckets = max(1, min(-(-n_edges // edges_per_task), MAX_BUCKETS))
    salted = edges.join(hubs, "src", "left").select(
        "src", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("dst"), F.col("salts"))).otherwise(F.lit(0))
        .cast("int").alias("salt"), "dst")
    name = f"wf_bfs_{uuid.uuid4().hex[:12]}"
    (salted.repartition(buckets, "src", "salt").write.bucketBy(buckets, "src", "salt")
     .option("path", scratch_path(spark, "bfs_edges")).mode("errorifexists").saveAsTable(name))
    return spark.table(name), name


class SeenNodes:
    """Nodes reached so far, as runs that are merged at doubling sizes."""

    def __init__(self, spark: SparkSession, before: DataFrame | None):
        self.spark, self.runs = spark, []
        if before is not None:
            table = cut_lineage(before.select("node"))
            self.runs.append((table, table.count()))

    def add(self, nodes: DataFrame, count: int) -> None:
        self.runs.append((nodes.select("node"), count))
        while len(self.runs) > 1 and self.runs[-2][1] <= 2 * self.runs[-1][1]:
            (a, n), (b, m) = self.runs.pop(-2), self.runs.pop()
            self.runs.append((cut_lineage(a.unionByName(b)), n + m))

    def without(self, reached: DataFrame, count: int) -> DataFrame:
        """Rows of ``reached`` whose node was not seen."""
        if not self.runs:
            return reached
        seen = self.runs[0][0]
        for run, _ in self.runs[1:]:
            seen = seen.unionByName(run)
        if count > BROADCAST_LEVEL:
            return reached.join(seen, "node", "left_anti")
        again = seen.join(F.broadcast(reached.select("node")), "node", "left_semi")
        return reached.join(F.broadcast(again), "node", "left_anti")  # no more rows than ``reached``


def crawl_frontier(edges: DataFrame, seeds: DataFrame, max_depth: int | None,
                   already_seen: DataFrame | None = None, hub_degree: int = HUB_DEGREE,
                   edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """Breadth-first levels from ``seeds(node)`` over ``edges(src, dst)``.

    Returns ``(node, depth, parent)``: every node reached within ``max_depth``
    steps at its lowest depth; ``parent`` is the lowest-named node of the
    previous level that links to it (null for seeds).  Nodes in
    ``already_seen(node)`` are never entered (the store of earlier runs).
    Stops when a level is empty or ``max_depth`` is reached.
    """
    spark: SparkSession = edges.sparkSession
    edges = cut_lineage(edges.select("src", "dst"))
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    hubs = cut_lineage(degrees.where(F.col("deg") > hub_degree).select(
        "src", F.ceil(F.col("deg") / edges_per_task).cast("int").alias("salts")))
    table, name = _bucketed_edges(edges, hubs, edges.count(), edges_per_task)
    base = scratch_path(spark, "bfs_levels")
    seen = SeenNodes(spark, already_seen)

    def write(rows: DataFrame, depth: int) -> tuple[DataFrame, int]:
        rows.select("node", "parent").write.parquet(f"{base}/depth={depth}")
        level = spark.read.schema("node string, parent string").parquet(f"{base}/depth={depth}")
        return level, level.count()

    start = seeds.select("node", F.lit(None).cast("string").alias("parent")).where("node is not null").distinct()
    start = cut_lineage(start)
    level, count = write(seen.without(start, start.count()), 0)
    depth = 0
    while count and (max_depth is None or depth < max_depth):
        seen.add(level, count)
        front = level.select(F.col("node").alias("src")).join(hubs, "src", "left").select("src", F.explode(
            F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.lit(0)))).alias("salt"))
        reached = cut_lineage(table.join(front, ["src", "salt"]).groupBy(F.col("dst").alias("node")).agg(
            F.min("src").alias("parent")).where("node is not null"))
        depth += 1
        level, count = write(seen.without(reached, reached.count()), depth)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema("node string, parent string, depth int").parquet(base).select("node", "depth", "parent")
