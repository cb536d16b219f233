"""Seed readers (O1, O2, D16) and stream back-pressure (O67, test only)."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from webfoot.sources import seeds
from webfoot.streaming import streams


def test_positional_lines_trimmed_fields_not(spark):
    df = spark.createDataFrame([("  1,page,a.example.com \n",), ("2,page, b.com",)], "value string")
    got = [tuple(r) for r in seeds.parse_positional(df).collect()]
    assert got == [("https://a.example.com", "a.example.com"), ("https:// b.com", " b.com")]


def test_short_positional_line_raises(spark):
    df = spark.createDataFrame([("1,page",)], "value string")
    with pytest.raises(Exception):
        seeds.parse_positional(df).collect()


def test_header_csv_reads_host_and_ip(spark):
    d = tempfile.mkdtemp(prefix="wf-test-")
    with open(os.path.join(d, "s.csv"), "w") as fh:
        fh.write("ip,host,extra\n10.0.0.1,a.com,x\n10.0.0.2,b.com,y\n")
    got = sorted(tuple(r) for r in seeds.read_header(spark, d).collect())
    assert got == [("http://a.com", "a.com", "10.0.0.1"), ("http://b.com", "b.com", "10.0.0.2")]


def test_page_stream_back_pressure(spark):
    """One file per trigger: the stream advances in bounded steps and ends with availableNow."""
    src = streams.page_stream(spark, "/root/testdata/sf0.001", files_per_trigger=1)
    q = (src.groupBy().agg(F.count(F.lit(1)).alias("n")).writeStream.outputMode("complete")
         .format("memory").queryName("wf_bp_test").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("wf_bp_test").first().n == 50


def test_scans_keep_their_splits_unless_asked(spark):
    from webfoot.sources import tables
    path = "/root/testdata/sf0.001"
    assert "Exchange" not in tables.pages(spark, path)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(tables.SCAN_PARTITIONS, "5")
    try:
        assert "RoundRobinPartitioning(5)" in tables.pages(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(tables.SCAN_PARTITIONS)


def test_no_local_folder_on_a_cluster(monkeypatch):
    from webfoot import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
