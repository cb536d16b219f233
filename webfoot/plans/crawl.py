"""The URL crawl whose step is a fetch (O70, O57, O54, O36, O30d).

A fetch is what the attempt log says of a target: its tries are settled to one
outcome, and a success brings the capture's links.  That table is made once
(``fetch_table``): one shuffle of the log, the HTML is scanned where it is
read and only references and titles move.  It is written in buckets by target.

A level joins its front to the fetch table, which stays where it is (a small
front is broadcast, a large one is dealt to the buckets), and is written as one
folder.  The links of its successes, reduced to one parent each, less all that
was seen, are the next front.  Seen are the targets of all levels, the keys
their records got (a failure rewrites the URL, D6) and the keys of an earlier
store, failures included (D10).

A level's folder counts once Spark has committed it (its ``_SUCCESS`` file), so
the folders are the crawl's manifest: started again with the same ``base``, a
crawl reads the committed levels and goes on after the last, writing a level
that a killed driver left half done anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import attempts, domains, graph, links
from ..session import cut_lineage, scratch_path
from .jobs import URL_FIELDS

# --- fixed values: shape of the fetch table ---
ROWS_PER_BUCKET = 1_000_000
LINKS = "struct<a:array<string>,link:array<string>,script:array<string>,img:array<string>>"
LEVEL = ("node string, parent string, status int, tries int, url string, fqdn string, sld string, redirect string, "
         f"next_url {LINKS}, url_nums int, title string, html string, screenshot string, exception string")
# --- end of fixed values ---


def fetch_table(captures: DataFrame, log: DataFrame, rules: DataFrame, html_out: str | None = None,
                screen_out: str | None = None, max_tries: int = attempts.MAX_TRIES) -> DataFrame:
    """One row per target of ``log``: the record that fetching it gives, but for its referrer.

    ``captures(url, html)`` has one row per URL.  Links are resolved against
    the URL that succeeded; host, domain and file names come from the target
    (D6).  A success without a capture has no links.
    """
    refs = links.extract_refs(captures, keep=("url",)).select(
        F.col("url").alias("target"), F.col("title").alias("page_title"), "refs")
    none = F.array().cast("array<struct<kind:string,raw:string>>")
    good = F.col("status") == 200
    told = attempts.resolve_fetches(log, max_tries).join(refs, "target", "left")
    told = told.withColumn("title", F.when(good, F.coalesce("page_title", "title")).otherwise(F.col("title"))) \
        .withColumn("refs", F.when(good, F.coalesce("refs", none)).otherwise(none)).drop("page_title")
    rows = links.bundle(told, "url").select(
        "target", "status", "tries", "url", U.url_host("target").alias("fqdn"), "redirect",
        F.col("next_url").cast(LINKS).alias("next_url"), F.col("url_nums").cast("int").alias("url_nums"), "title",
        U.artifact_path(html_out, "target", "html").alias("html"),
        U.artifact_path(screen_out, "target", "png").alias("screenshot"), "exception")
    return domains.with_registrable_domain(rows, rules, "fqdn", "sld")


def _committed(spark: SparkSession, base: str) -> int:
    """The number of levels that ``base`` holds whole."""
    sc, depth = spark.sparkContext, 0
    while True:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{base}/depth={depth}/_SUCCESS")
        if not path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path):
            return depth
        depth += 1


def _reached(level: DataFrame) -> DataFrame:
    """``(node, parent)``: what the successes of a level link to."""
    found = level.where("status = 200").select(
        F.col("url").alias("parent"), F.explode_outer(F.array_distinct("next_url.a")).alias("node"))
    return cut_lineage(found.where("node is not null").groupBy("node").agg(F.min("parent").alias("parent")))


def _names(level: DataFrame) -> DataFrame:
    """What a level makes seen: its targets and their records' keys."""
    return level.select(F.explode(F.array_distinct(F.array_compact(F.array("node", "url")))).alias("node"))


def crawl(fetches: DataFrame, seeds: DataFrame, base: str | None = None, max_depth: int | None = None,
          store: DataFrame | None = None) -> DataFrame:
    """Records of all that ``seeds(node)`` lead to, with ``node`` (the target) and ``depth``.

    ``pre_url`` is the lowest-named key of the level before that links to the
    target.  ``store(key)`` holds keys of earlier runs; they are not fetched.
    Targets without an attempt have no record (D17).  ``base`` names the
    levels' folder: a crawl that was stopped goes on from there.
    """
    spark = fetches.sparkSession
    base = (base or scratch_path(spark, "crawl")).rstrip("/")
    done = _committed(spark, base)

    def read(depth: int) -> DataFrame:
        return spark.read.schema(LEVEL).parquet(f"{base}/depth={depth}")

    def whole() -> DataFrame:
        return spark.read.schema(LEVEL + ", depth int").parquet(base).select(
            "node", "depth", *[c for c in URL_FIELDS if c != "pre_url"], F.array("parent").alias("pre_url"), "tries") \
            .where("status is not null").select("node", "depth", *URL_FIELDS, "tries")

    held = cut_lineage(fetches)
    buckets = max(1, min(-(-held.count() // ROWS_PER_BUCKET), graph.MAX_BUCKETS))
    name = f"wf_fetch_{uuid.uuid4().hex[:12]}"
    (held.repartition(buckets, "target").write.bucketBy(buckets, "target")
     .option("path", scratch_path(spark, "fetches")).mode("errorifexists").saveAsTable(name))
    try:
        table = spark.table(name)
        seen = graph.SeenNodes(spark, None if store is None else store.select(F.col("key").alias("node")))
        for depth in range(done):
            seen.add(_names(read(depth)), 2 * read(depth).count())
        depth = done
        if done:
            reached = _reached(read(done - 1))
        else:
            reached = cut_lineage(seeds.select("node", F.lit(None).cast("string").alias("parent"))
                                  .where("node is not null").distinct())
        while max_depth is None or depth <= max_depth:
            front = seen.without(reached, reached.count())
            rows = front.join(table.withColumnRenamed("target", "node"), "node", "left").select(
                *[F.col(f.split(" ")[0]) for f in LEVEL.replace(LINKS, "links").split(", ")])
            rows.write.mode("overwrite").parquet(f"{base}/depth={depth}")  # a half-written level is replaced
            level = read(depth)
            count = level.count()
            if not count:
                break
            seen.add(_names(level), 2 * count)  # merged runs are written, a single level is read as it lies
            reached = _reached(level)
            depth += 1
        return whole()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
