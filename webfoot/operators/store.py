"""Keyed record store and ordered index.

The store is a table ``(store, key_md5, key, value, seq)``: ``value`` is the
record as JSON with nulls kept, ``seq`` the write order.  An upsert is a
union of the old version and the new writes reduced to the newest ``seq`` per
``(store, key_md5)``, written as a new version under the shared checkpoint
folder (plain parquet has no row-level MERGE; the path being read is never
overwritten).

The write-order index (``set_name, member, score``) is built without a
global single-partition window: rows are range-sorted, each partition's size
is counted (one row per partition), and a partition's offset is the sum of
the sizes before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path

STORE_SCHEMA = "store string, key_md5 string, key string, value string, seq bigint"
INDEX_SCHEMA = "set_name string, member string, score bigint"


def record_json(df: DataFrame, fields: list[str]) -> DataFrame:
    """``value`` = JSON of ``fields`` with nulls kept, dates as ISO text.

    ``next_url`` is written as four lists in the order of its kinds; ``ipinfo``
    as an object, or as the text in ``outcome`` where the lookup failed.
    """
    cols = []
    for f in df.schema.fields:
        if f.name not in fields:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif f.name == "next_url" and isinstance(f.dataType, T.StructType):
            c = F.array(*[c[k] for k in f.dataType.names])
        elif f.name == "ipinfo" and "outcome" in df.columns:
            c = F.when(F.col("outcome") == "ok", F.parse_json(F.to_json(F.col("ipinfo")))).otherwise(
                F.parse_json(F.concat(F.lit('"'), F.col("outcome"), F.lit('"'))))
        cols.append(c.alias(f.name))
    return df.withColumn("value", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def to_store_rows(df: DataFrame, store: str, key: str, seq: str, fields: list[str]) -> DataFrame:
    """Records -> store rows keyed by ``md5(key)``."""
    j = record_json(df, fields)
    return j.select(F.lit(store).alias("store"), F.md5(F.col(key).cast("string")).alias("key_md5"),
                    F.col(key).cast("string").alias("key"), "value", F.col(seq).cast("bigint").alias("seq"))


def newest_per_key(rows: DataFrame) -> DataFrame:
    """Last writer wins per (store, key_md5); of equal ``seq`` the larger value; ``max_by`` combines map-side."""
    g = rows.groupBy("store", "key_md5").agg(
        F.max_by(F.struct("key", "value", "seq"), F.struct("seq", "value", "key")).alias("__wf_w"))
    return g.select("store", "key_md5", "__wf_w.key", "__wf_w.value", "__wf_w.seq")


def upsert(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The store after writing ``new`` on top of ``old`` (lazy)."""
    rows = new if old is None else old.unionByName(new)
    return newest_per_key(rows)


def write_version(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write one store/index version to a fresh path and read it back."""
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def lookup(keys: DataFrame, key: str, store: DataFrame, schema: str | T.StructType, name: str) -> DataFrame:
    """Read records of the store ``name`` back by key digest and decode the JSON."""
    k = keys.withColumn("__wf_md5", F.md5(F.col(key).cast("string")))
    s = store.where(F.col("store") == name).select(F.col("key_md5").alias("__wf_md5"), "value")
    j = k.join(s, "__wf_md5", "left")
    return j.withColumn("record", F.from_json("value", schema)).drop("__wf_md5")


def write_index(df: DataFrame, set_name: str, member: str, order: list[str],
                base: int = 0) -> DataFrame:
    """Counter per write in ``order``; per member the newest counter.

    ``order`` must be a total order.  The sorted, numbered rows are
    checkpointed so the numbering is computed once.
    """
    spark = df.sparkSession
    sorted_df = df.select(F.col(member).cast("string").alias("member"), *order).orderBy(*order)
    numbered = cut_lineage(sorted_df.select(
        "member", F.spark_partition_id().alias("__wf_pid"),
        F.monotonically_increasing_id().alias("__wf_mono")))
    counts = numbered.groupBy("__wf_pid").agg(
        F.count(F.lit(1)).alias("__wf_n"), F.min("__wf_mono").alias("__wf_first"))
    # One row per partition: a single-partition window over it is tiny.
    offsets = counts.select(
        "__wf_pid", "__wf_first",
        (F.sum("__wf_n").over(Window.orderBy("__wf_pid")
                              .rowsBetween(Window.unboundedPreceding, -1))).alias("__wf_off"))
    offsets = F.broadcast(offsets.fillna(0, subset=["__wf_off"]))
    idx = numbered.join(offsets, "__wf_pid").select(
        "member",
        (F.lit(base) + F.col("__wf_off") + F.col("__wf_mono") - F.col("__wf_first")).alias("score"))
    return idx.groupBy("member").agg(F.max("score").alias("score")).select(
        F.lit(set_name).alias("set_name"), "member", "score")


def html_archive(spark: SparkSession, pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """The page HTML stored as a table with its ``sld`` and ``html_path`` columns.

    ``pages`` needs ``url, sld, html_path, html``.  Returns the read-back table.
    Rows are sorted by ``(sld, url)`` inside each task and written without
    directory partitioning: one file per task and no shuffle of the HTML,
    while the sorted row groups let a lookup by ``sld`` skip most of each
    file.  (Partitioning by ``sld`` itself would make one folder per domain
    and a file per task and domain, far too many files at scale.)
    """
    path = out_dir or scratch_path(spark, "html_archive")
    (pages.select("sld", "url", "html_path", "html").sortWithinPartitions("sld", "url")
     .write.mode("errorifexists").parquet(path))
    return spark.read.schema("sld string, url string, html_path string, html string").parquet(path)
