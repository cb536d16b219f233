"""Streams give the batch result."""
from webfoot.plans import queries as Q
from webfoot.streaming import streams

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_pages_equals_batch(spark):
    batch = Q._url_records(spark, SF).select("url", "fqdn", "sld", "url_nums", "title", "status")
    assert _rows(streams.stream_pages(spark, SF)) == _rows(batch)


def test_stream_unseen_equals_batch(spark):
    from webfoot.operators import links
    from webfoot.sources import tables
    batch = links.page_edges(links.extract_refs(tables.pages(spark, SF))).select("dst").distinct()
    assert _rows(streams.stream_unseen(spark, SF)) == _rows(batch)


def test_stream_chain_equals_batch(spark):
    from pyspark.sql import functions as F
    from webfoot.plans import jobs
    from webfoot.sources import fixtures as FX
    pairs = Q._addresses(spark, SF).select("ip", "fqdn", F.lit(1).alias("src"), F.lit(0).alias("idx"))
    batch = jobs.ip_records(pairs, FX.ip_blocks(spark, SF)).select("ip", "fqdn", "outcome")
    assert _rows(streams.stream_chain(spark, SF)) == _rows(batch)


def _split(spark, tmp_path, n=3):
    """The pages as several files, in a folder as the streams expect it."""
    import os
    import shutil
    root = str(tmp_path / "sf")
    os.makedirs(root)
    spark.read.parquet(f"{SF}/pages.parquet").repartitionByRange(n, "page_id").write.parquet(f"{root}/pages.parquet")
    for t in ("nation",):
        shutil.copy(f"{SF}/{t}.parquet", root)
    return root


def test_several_batches_add_up(spark, tmp_path):
    """Three files, three micro-batches: the batch result, and no batch rewrites an earlier one's rows."""
    root = _split(spark, tmp_path)
    base = str(tmp_path / "chain")
    assert _rows(streams.stream_chain(spark, root, base)) == _rows(streams.stream_chain(spark, SF))
    sizes = {r.batch: r["count"] for r in spark.read.parquet(f"{base}/dns").groupBy("batch").count().collect()}
    st = spark.read.parquet(f"{base}/dns")
    assert st.count() == st.select("key").distinct().count() == sum(sizes.values()) and len(sizes) >= 2
    assert _rows(streams.stream_unseen(spark, root)) == _rows(streams.stream_unseen(spark, SF))
    assert _rows(streams.stream_pages(spark, root)) == _rows(streams.stream_pages(spark, SF))


def test_stream_chain_resumes_and_replays_idempotently(spark):
    """A second run on the same folder finds everything done; a replayed batch rewrites the same version."""
    from webfoot.session import scratch_path
    base = scratch_path(spark, "chain_resume")
    first = _rows(streams.stream_chain(spark, SF, base))
    again = _rows(streams.stream_chain(spark, SF, base))       # resumes: no new input
    assert first == again and first
    st = streams._Stores(spark, SF, base)
    before = _rows(st.version("ip"))
    batch_df = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    st.batch(batch_df, 0)                                       # replay batch 0
    assert _rows(st.version("ip")) == before
