"""Two-level seen check: exact whatever the filter holds; replays, folds, what the digests meet."""
import os
import random

from webfoot.operators.seenfilter import SeenFilter
from webfoot.streaming import streams


def df(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "url string, page int")


def test_batches_against_a_set(spark, tmp_path):
    rng = random.Random(2)
    for places in (1 << 36, 1 << 15, 64):  # the last is full at once: all keys meet the digests
        known, seen = SeenFilter(spark, str(tmp_path / str(places)), places), set()
        for batch in range(3):
            keys = [f"u{rng.randrange(600)}" for _ in range(200)]
            new = known.unseen(df(spark, keys + [None]), "url", batch)
            assert sorted((r.url or "") for r in new.collect()) == sorted([k for k in keys if k not in seen] + [""])
            assert new.columns == ["url", "page"]
            known.add(df(spark, keys + [None]), "url", batch)
            known.add(df(spark, keys), "url", batch)  # run again
            assert sorted(r.url for r in known.unseen(df(spark, keys), "url", batch).collect()) == sorted(k for k in keys if k not in seen)
            seen |= set(keys)
            if batch == 1:
                known.fold(1)
        every = [f"u{i}" for i in range(600)]
        assert {r.url for r in known.unseen(df(spark, every), "url", 3).collect()} == set(every) - seen


def test_an_unfinished_folder_does_not_count(spark, tmp_path):
    known = SeenFilter(spark, str(tmp_path / "s"))
    known.add(df(spark, ["a", "b"]), "url", 0)
    os.makedirs(tmp_path / "s" / "fold-0" / "keys")
    assert [r.url for r in known.unseen(df(spark, ["a", "c"]), "url", 1).collect()] == ["c"]


def test_stream_keeps_no_state_and_finds_each_target_once(spark, tmp_path):
    sf = tmp_path / "sf"
    (sf / "pages.parquet").mkdir(parents=True)
    links = {0: ["/a", "/b"], 1: ["/b", "/c"], 2: ["/a", "/c"], 3: ["/d"]}
    for i, refs in links.items():
        html = "".join(f'<a href="{r}">x</a>' for r in refs)
        spark.createDataFrame([(i, "https://h/", html)], "page_id bigint, url string, html string").coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        part = next(f for f in os.listdir(tmp_path / f"w{i}") if f.endswith(".parquet"))
        os.link(tmp_path / f"w{i}" / part, sf / "pages.parquet" / f"p{i}.parquet")
    base = str(tmp_path / "stream")
    got = [r.target for r in streams.stream_seen(spark, str(sf), base, fold_every=2).collect()]
    assert sorted(got) == ["https://h/a", "https://h/b", "https://h/c", "https://h/d"]
    assert not os.path.exists(f"{base}/checkpoint/state")
    again = [r.target for r in streams.stream_seen(spark, str(sf), base, fold_every=2).collect()]
    assert sorted(again) == sorted(got)
