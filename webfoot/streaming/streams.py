"""Structured Streaming versions of the collectors.

The reference's work queues become streams: a file source with an explicit
schema (new captures land as files), ``trigger(availableNow=True)`` as the
end-of-input marker (O64), ``maxFilesPerTrigger`` as back-pressure (O67),
and sinks that are exactly-once (file sink, or ``foreachBatch`` writing a
new store version per batch id).  Checkpoints and sinks live under the
shared checkpoint folder.

* ``stream_pages``: captures -> URL records (O70 per micro-batch) -> file sink.
* ``stream_unseen``: link targets de-duplicated over all time (O63).  With no
  watermark the de-duplication state holds every key ever seen (the
  reference's store never expires keys either); it lives in the state store,
  which spills to disk and survives restarts through the checkpoint.
* ``stream_chain``: captures -> hosts -> DNS -> IP, each store extended by its
  new keys per micro-batch inside one ``foreachBatch`` (O65).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import links, seenfilter
from ..operators import store as S
from ..plans import jobs
from ..session import scratch_path
from ..sources import fixtures as FX

PAGES_SCHEMA = "page_id bigint, url string, html string"


def page_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Captured pages as a stream (file source, explicit schema).

    Captures normally land as files in a folder; the test tables are single
    files, so the path is the glob ``{pages}.parquet`` (a glob keeps the
    folder as the base path).
    """
    root = sf_dir.rstrip("/")
    return (spark.readStream.schema(PAGES_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("basePath", root).option("recursiveFileLookup", "true")
            .parquet(f"{root}/{{pages}}.parquet"))


def _run_to_end(writer, name: str):
    """Start with ``availableNow`` (O64) and wait until all input is processed."""
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")


STREAM_RECORD_SCHEMA = "url string, fqdn string, sld string, url_nums int, title string, status int"


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O70 per micro-batch; each batch id writes its own folder (idempotent on replay)."""
    rules = FX.suffix_rules(spark)
    out, ck = scratch_path(spark, "stream_pages_out"), scratch_path(spark, "stream_pages_ck")

    def batch(pages: DataFrame, batch_id: int) -> None:
        rec = jobs.url_records(pages, rules, None, None)
        rec.select("url", "fqdn", "sld", "url_nums", "title", "status") \
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run_to_end(page_stream(spark, sf_dir).writeStream.foreachBatch(batch)
                .option("checkpointLocation", ck), "stream_pages")
    cols = [c.split()[0] for c in STREAM_RECORD_SCHEMA.split(", ")]
    return spark.read.parquet(out).select(*cols)


def stream_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = links.extract_refs(page_stream(spark, sf_dir))
    targets = links.page_edges(refs).select(F.col("dst").alias("target"))
    uniq = targets.dropDuplicates(["target"])
    out, ck = scratch_path(spark, "stream_unseen_out"), scratch_path(spark, "stream_unseen_ck")
    _run_to_end(uniq.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", ck).outputMode("append"), "stream_unseen")
    return spark.read.schema("target string").parquet(out)


def stream_seen(spark: SparkSession, sf_dir: str, base: str | None = None, fold_every: int = 16) -> DataFrame:
    """O63/O36 without streaming state: each batch's new link targets, told by the two-level seen check.

    A batch writes its targets and then its keys; a batch that is run again
    replaces both.
    """
    base = base or scratch_path(spark, "stream_seen")
    known = seenfilter.SeenFilter(spark, f"{base}/seen")

    def batch(pages: DataFrame, batch_id: int) -> None:
        targets = links.page_edges(links.extract_refs(pages)).select(F.col("dst").alias("target")).distinct()
        folder = f"{base}/out/batch={batch_id}"
        known.unseen(targets, "target", batch_id).write.mode("overwrite").parquet(folder)
        known.add(spark.read.schema("target string").parquet(folder), "target", batch_id)
        if batch_id % fold_every == fold_every - 1:
            known.fold(batch_id)

    _run_to_end(page_stream(spark, sf_dir).writeStream.foreachBatch(batch)
                .option("checkpointLocation", f"{base}/checkpoint"), "stream_seen")
    return spark.read.schema("target string").parquet(f"{base}/out").select("target")


class _Stores:
    """DNS and IP stores of a chained stream, one folder of new records per micro-batch.

    ``{base}/{kind}/batch={id}`` holds only the keys that batch ``id`` brought:
    the seen check lets no key in twice, so nothing is ever rewritten and the
    store is all folders together.  A batch sees the folders before its own
    and writes its own with overwrite, so a batch replayed after a failure
    (same id) writes exactly the same rows, and a restarted driver finds the
    stores where the last run left them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.answers = FX.dns_answers(spark, sf_dir)
        self.blocks = FX.ip_blocks(spark, sf_dir)
        self.rules = FX.suffix_rules(spark)
        # An empty folder -1 (written only if absent), so every read finds the store.
        empty = spark.createDataFrame([], S.STORE_SCHEMA)
        for kind in ("dns", "ip"):
            empty.write.mode("ignore").parquet(f"{self.base}/{kind}/batch=-1")

    def version(self, kind: str, before: int | None = None) -> DataFrame:
        """The store of ``kind`` (as it was before batch ``before`` if given); the folders are pruned, no job runs."""
        rows = self.spark.read.schema(S.STORE_SCHEMA + ", batch bigint").parquet(f"{self.base}/{kind}")
        return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")

    def _write(self, kind: str, df: DataFrame, batch_id: int) -> DataFrame:
        path = f"{self.base}/{kind}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(S.STORE_SCHEMA).parquet(path)

    def batch(self, pages: DataFrame, batch_id: int) -> None:
        dns_store, ip_store = self.version("dns", batch_id), self.version("ip", batch_id)
        hosts = pages.select(U.url_host("url").alias("fqdn")).where(F.col("fqdn") != "")
        dns = jobs.dns_records(hosts, self.answers, self.rules, FX.RTYPES, store=dns_store)
        dns = dns.withColumn("seq", F.lit(batch_id).cast("bigint"))
        new = self._write("dns", S.newest_per_key(S.to_store_rows(dns, "dns", "fqdn", "seq", jobs.DNS_FIELDS)), batch_id)
        # Only the hosts new in this batch, read back, bring addresses.
        answers = self.answers.join(new.select(F.col("key").alias("fqdn")), "fqdn", "left_semi")
        pairs = jobs.dns_to_ip(answers, ip_store)
        cand = pairs.select("ip", "fqdn", F.lit(1).alias("src"), F.lit(batch_id).alias("idx"))
        ipr = jobs.ip_records(cand, self.blocks, store=ip_store).withColumn("seq", F.lit(batch_id).cast("bigint"))
        ip_rows = S.to_store_rows(ipr, "ip", "ip", "seq", jobs.IP_FIELDS + ["outcome"])
        self._write("ip", S.newest_per_key(ip_rows), batch_id)


def stream_chain(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """Captures -> hosts -> DNS -> IP per micro-batch; returns the IP store's records.

    ``base`` is the stream's folder (checkpoint and store versions); pass the
    same one to resume after a restart.
    """
    base = (base or scratch_path(spark, "stream_chain")).rstrip("/")
    stores = _Stores(spark, sf_dir, base)
    src = page_stream(spark, sf_dir).select("page_id", "url")
    _run_to_end(src.writeStream.foreachBatch(stores.batch).option("checkpointLocation", f"{base}/checkpoint"),
                "stream_chain")
    ip = stores.version("ip")
    rec = F.from_json("value", "ip string, fqdn string, outcome string")
    return ip.select(rec.ip.alias("ip"), rec.fqdn.alias("fqdn"), rec.outcome.alias("outcome"))


def queries() -> dict:
    return {
        "stream_pages": stream_pages,
        "stream_unseen": stream_unseen, "stream_seen": stream_seen,
        "stream_chain": stream_chain,
    }
