"""WARC round trip and salvage of damaged archives."""
import hashlib
import os

from webfoot.llm import queries, warc

SF = "/root/testdata/sf0.001"


def _expect(rows):
    groups = {}
    for i, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for p, ids in groups.items():
        top = max(ids)
        for i in ids:
            again = len(p) >= 1000 and i < top
            out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_query_is_an_exact_round_trip(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op7_warc(spark, SF).collect()), key=str) == _expect(rows)


def test_round_trip_of_odd_rows(spark, tmp_path):
    big = "x" * 3_000_000
    rows = [(1, "http://a/", None), (2, None, ""), (3, "http://a/\r\nX: y", "WARC/1.1\r\n\r\nnested\r\n\r\n"),
            (4, "u", big), (5, "u", big), (5, "u", big), (6, "u", "é" * 600), (7, "u", "é" * 600), (8, "u", "short"), (9, "u", "short")]
    df = spark.createDataFrame([r + ("extra",) for r in rows], "page_id long, url string, html string, payload string")
    path, manifest = warc.write_archives(df, str(tmp_path / "w"), archive_bytes=1 << 12)
    back = warc.read_archives(spark, path).collect()
    assert {r.kind for r in back} == {"record"} and sum(r.records for r in manifest.collect()) == len(rows)
    got = sorted([(r.row_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back], key=str)
    assert got == _expect([(i, h) for i, _, h in rows])
    texts = {r.row_id: bytes(r.payload) for r in back if r.record_type == "response"}
    assert texts[3].decode() == rows[2][2] and texts[5].decode() == big
    empty, _ = warc.write_archives(df.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, empty).count() == 0


def _records(n):
    out = []
    for i in range(n):
        p = (f"<p>{i}</p>" * 200).encode()
        out.append(warc.record_bytes(i, f"http://h/{i}", p, len(p), hashlib.sha1(p).hexdigest(), "response", None))
    return out


def _ids(found):
    return [warc._row_id(h["warc-record-id"]) for kind, _, _, h, _ in found if kind == "record"]


def test_salvage_of_members():
    members = [warc.member(r) for r in _records(8)]
    broken = bytearray(members[3])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join(members[:3]) + bytes(broken) + members[4] + b"garbage \x1f\x8b\x08 more" + members[5] + members[6] + members[7][:-9]
    found = list(warc.salvage(data))
    assert _ids(found) == [0, 1, 2, 4, 5, 6, 7]  # 3 has a garbled header, of 7 only the member's end is cut
    assert [h["x-salvaged"] for kind, _, _, h, _ in found if kind == "record" and "x-salvaged" in h] == ["truncated member"]
    gaps = [(o, n) for kind, o, n, *_ in found if kind == "gap"]
    records = [(o, n) for kind, o, n, *_ in found if kind == "record"]
    covered = sorted(set(gaps + records))
    assert covered[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(covered, covered[1:]))
    assert sum(n for _, n in covered) == len(data) and len(gaps) == 3


def test_salvage_of_plain_records():
    r = _records(6)
    bad = r[2].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    flipped = r[4].replace(b"<p>4</p>", b"<p>5</p>", 1)
    found = list(warc.salvage(r[0] + r[1] + bad + r[3] + flipped + r[5]))
    assert _ids(found) == [0, 1, 3, 5]
    assert [x[3] for x in found if x[0] == "gap"][1] == "block digest differs"
    assert list(warc.salvage(b"")) == [] and [x[0] for x in warc.salvage(b"\x00" * 100)] == ["gap"]
    assert _ids(warc.salvage(warc.member(r[0] + r[1]) + r[2])) == [0, 1, 2]


def test_damaged_archive_through_spark(spark, tmp_path):
    data = b"".join(map(warc.member, _records(5)))
    (tmp_path / "a.warc.gz").write_bytes(data[:200] + b"\xff\xff\xff" + data[203:])
    (tmp_path / "b.warc").write_bytes(b"".join(_records(2)))
    rows = warc.read_archives(spark, str(tmp_path), payloads=False).collect()
    assert sum(r.kind == "record" for r in rows) >= 6 and any(r.kind == "gap" and r.reason for r in rows)
    assert {os.path.basename(r.file) for r in rows} == {"a.warc.gz", "b.warc"}


def test_half_of_a_member_gives_its_whole_records():
    """One member of many records, cut off or with a flipped byte: what stands before is recovered."""
    records = _records(100)
    whole = warc.member(b"".join(records))
    cut = list(warc.salvage(whole[:-3]))
    assert _ids(cut) == list(range(100)) and cut[-1][0] == "gap" and "truncated" in cut[-1][3]
    half = list(warc.salvage(whole[:len(whole) // 2]))
    assert 40 <= len(_ids(half)) < 60 and _ids(half) == list(range(len(_ids(half))))
    flipped = bytearray(whole)
    flipped[-6] ^= 1  # the member's CRC
    assert _ids(warc.salvage(bytes(flipped))) == list(range(100))
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 0x55
    found = list(warc.salvage(bytes(flipped) + warc.member(records[7])))
    ids = _ids(found)
    assert ids[-1] == 7 and ids[:-1] == sorted(set(ids[:-1])) and len(ids) > 40 and set(range(40)) < set(ids)
    blocks = {warc._row_id(h["warc-record-id"]): b for kind, _, _, h, b in found if kind == "record"}
    assert all(b == warc.parse_record(records[i], 0)[1] for i, b in blocks.items())
    covered = {(o, n) for _, o, n, *_ in found}
    assert min(o for o, _ in covered) == 0 and max(o + n for o, n in covered) == len(whole) + len(warc.member(records[7]))
