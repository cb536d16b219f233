"""Store upsert, lookup and the write-order index."""
from pyspark.sql import functions as F

from webfoot.operators import store as S
from webfoot.sources import tables

SF = "/root/testdata/sf0.001"


def _writes(spark):
    ev = tables.events(spark, SF)
    return ev.select(F.col("user_id").cast("string").alias("key"), "event_id", "ts", "event_type")


def test_last_writer_wins_and_idempotent(spark):
    w = _writes(spark)
    rows = S.to_store_rows(w, "events", "key", "event_id", ["key", "event_id", "event_type"])
    once = S.upsert(None, rows)
    twice = S.upsert(once, rows)
    assert once.schema.simpleString() == "struct<" + S.STORE_SCHEMA.replace(" ", ":").replace(",:", ",") + ">"
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    expect = {}
    for r in w.collect():
        if r.key not in expect or r.event_id > expect[r.key]:
            expect[r.key] = r.event_id
    assert {r.key: r.seq for r in once.collect()} == expect


def test_json_keeps_nulls_and_round_trips(spark):
    df = spark.createDataFrame([("u", None, 3)], "url string, title string, n int")
    j = S.record_json(df, ["url", "title", "n"]).first().value
    assert j == '{"url":"u","title":null,"n":3}'
    st = S.to_store_rows(df, "url", "url", "n", ["url", "title", "n"])
    got = S.lookup(spark.createDataFrame([("u",), ("v",)], "k string"), "k", st,
                   "url string, title string, n int", "url").orderBy("k").collect()
    assert got[0].record.n == 3 and got[0].record.title is None and got[1].record is None


def test_same_key_in_two_stores(spark):
    """A WHOIS key neither hides a DNS target nor answers a lookup in the URL store."""
    from webfoot.operators import seen
    df = spark.createDataFrame([("example.com", 1)], "k string, n int")
    st = S.to_store_rows(df, "whois", "k", "n", ["k", "n"])
    targets = spark.createDataFrame([("example.com",)], "k string")
    assert seen.unseen(targets, st, "k", "dns").count() == 1 and seen.unseen(targets, st, "k", "whois").count() == 0
    assert seen.already_seen(targets, st, "k", "whois").count() == 1 and seen.already_seen(targets, st, "k", "url").count() == 0
    assert S.lookup(targets, "k", st, "k string, n int", "url").first().record is None


def test_equal_write_order_is_decided(spark):
    rows = spark.createDataFrame([("s", "d", "k", v, 5) for v in ("a", "c", "b")], S.STORE_SCHEMA)
    assert [r.value for r in S.newest_per_key(rows.repartition(3)).collect()] == ["c"]


def test_json_shapes(spark):
    df = spark.sql("select 'u' url, named_struct('a', array('x'), 'link', array(), 'script', array('y','z'), 'img', array()) next_url")
    assert S.record_json(df, ["url", "next_url"]).first().value == '{"url":"u","next_url":[["x"],[],["y","z"],[]]}'
    ip = spark.sql("select * from values ('1.1.1.1', 'ok', named_struct('cidr', 'c', 'asn', 'a')), "
                   "('2.2.2.2', 'failed', null) t(ip, outcome, ipinfo)")
    got = {r.ip: r.value for r in S.record_json(ip, ["ip", "ipinfo"]).collect()}
    import json
    assert json.loads(got["1.1.1.1"])["ipinfo"] == {"cidr": "c", "asn": "a"} and json.loads(got["2.2.2.2"])["ipinfo"] == "failed"


def test_write_index_matches_enumeration(spark):
    w = _writes(spark)
    idx = S.write_index(w, "s", "key", ["ts", "event_id"])
    assert idx.schema.simpleString() == "struct<" + S.INDEX_SCHEMA.replace(" ", ":").replace(",:", ",") + ">"
    got = {r.member: r.score for r in idx.collect()}
    ordered = sorted(w.collect(), key=lambda r: (r.ts, r.event_id))
    expect = {}
    for i, r in enumerate(ordered):
        expect[r.key] = i
    assert got == expect
