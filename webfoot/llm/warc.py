"""WARC archives: a writer with identical-payload revisits and a salvage reader.

Writing.  Payload groups are found on SHA-1 and length with a partially
aggregated ``max(id)``; of a group of at least ``MIN_REVISIT_BYTES`` the row
with the largest id is the response and the others are revisits that name it.
Each task writes its rows, in id order, as one gzip member per record into
archives of bounded size in a folder that all executors share.  A file gets
its final name (made from partition and number) only when it is complete, and
a repeated task writes the same files again, so a lost executor leaves neither
half archives nor doubled records.

Reading.  Archives may be plain or compressed, with one or many records per
member.  Every member must pass gzip's own check, every record must have a
version line, a Content-Length that fits, the closing blank lines and, where
present, the right block digest.  After a failure the reader looks for the
next gzip magic or version line *that passes the same checks*, goes on from
there, and logs the bytes in between as a quarantined gap.

Memory: a task holds one archive (bounded by ``archive_bytes`` plus one
record) and one decompressed member at a time.

Defined cases: null payload is an empty payload; a null url writes no target;
line breaks in urls are percent-encoded; rows that repeat the largest id of
their group are all responses; rows with a null id in a group with ids are
revisits, in a group without ids all are responses; an empty table writes no
archive and reads back empty; other input columns are not archived.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from webfoot.llm.common import col, materialize
from webfoot.session import scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
CAPTURE_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16

RECORD_SCHEMA = ("file string, offset long, length long, kind string, reason string, row_id long, "
                 "record_type string, target_uri string, payload_bytes long, payload_digest string, "
                 "refers_to long")
PAYLOAD_SCHEMA = RECORD_SCHEMA + ", payload binary"


# ---------------------------------------------------------------- writing

def with_record_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                      min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(row_id, url, payload, payload_digest, record_type, refers_to)`` for each row."""
    rows = pages.select(
        col(id_col).cast("long").alias("row_id"), col(url_col).cast("string").alias("url"),
        F.coalesce(col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long"))
    groups = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max("row_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("keeper").isNotNull()).drop("n"))
    # Short payloads are never grouped, so they stay out of the join's key.
    key = F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest"))
    revisit = F.col("keeper").isNotNull() & (F.col("row_id").isNull() | (F.col("row_id") < F.col("keeper")))
    return (rows.withColumn("_key", key)
            .join(groups.select(F.col("payload_digest").alias("_key"), F.col("payload_bytes").alias("_n"), "keeper"),
                  ["_key"], "left")
            .select("row_id", "url", F.when(~revisit, F.col("payload")).alias("payload"),
                    "payload_bytes", "payload_digest",
                    F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
                    F.when(revisit, F.col("keeper")).alias("refers_to")))


def record_id(row_id: int | None) -> str:
    return f"<urn:x-row:{'' if row_id is None else row_id}>"


def record_bytes(row_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) -> bytes:
    """One WARC record; a revisit has an empty block."""
    if record_type == "response":
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                 + str(len(payload)).encode() + b"\r\n\r\n" + payload)
    else:
        block = b""
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(row_id)}",
            f"WARC-Date: {CAPTURE_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Payload-Length: {payload_bytes}",
             f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _store(path: str):
    """File system and folder of a path or URI."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> tuple[str, DataFrame]:
    """Write one record per row; returns the folder and the manifest ``(file, records, bytes)``."""
    spark = pages.sparkSession
    path = (path or scratch_path(spark, "warc")).rstrip("/")
    _store(path)[0].create_dir(_store(path)[1], recursive=True)
    rows = with_record_types(pages, id_col, url_col, payload_col, min_bytes).sortWithinPartitions(
        "row_id", "payload_digest", "url")

    def run(batches):
        from pyspark import TaskContext
        store, folder = _store(path)
        part, number, made = TaskContext.get().partitionId(), 0, []
        out = temp = None
        size = records = 0

        def close():
            nonlocal out, number
            out.close()
            name = f"part-{part:06d}-{number:05d}.warc.gz"
            store.move(temp, f"{folder}/{name}")
            made.append((name, records, size))
            out, number = None, number + 1

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                data = member(record_bytes(*row), level)
                if out is not None and size + len(data) > archive_bytes:
                    close()
                if out is None:
                    temp, size, records = f"{folder}/_{uuid.uuid4().hex}", 0, 0
                    out = store.open_output_stream(temp)
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            close()
        if made:
            names, counts, sizes = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["file", "records", "bytes"])

    manifest = rows.mapInArrow(run, "file string, records long, bytes long")
    return path, materialize(manifest, "warc-manifest")


# ---------------------------------------------------------------- reading

class Damaged(Exception):
    """A member or record that fails its checks; ``content`` is what a member held up to there."""

    def __init__(self, reason: str, content: bytes = b""):
        super().__init__(reason)
        self.content = content


def inflate(data: memoryview, at: int) -> tuple[bytes, int]:
    """The member at ``at`` and the offset after it; its CRC and length are checked by zlib."""
    unpack, parts, pos = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if pos >= len(data):
            raise Damaged("truncated member", b"".join(parts))
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(data[pos:pos + CHUNK]))
        except zlib.error as e:
            raise Damaged(f"bad member: {e}", b"".join(parts) + _until_error(before, data[pos:pos + CHUNK])) from None
        pos += CHUNK
    return b"".join(parts), min(pos, len(data)) - len(unpack.unused_data)


def _until_error(unpack, data: memoryview) -> bytes:
    """What can be decompressed of ``data`` before its error, in steps of a few bytes."""
    parts = []
    try:
        for at in range(0, len(data), 16):
            parts.append(unpack.decompress(data[at:at + 16]))
    except zlib.error:
        pass
    return b"".join(parts)


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    if not data.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("unterminated header")
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("malformed header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("no content length")
    start = end + 4
    stop = start + int(headers["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("truncated record" if stop + 4 > len(data) else "content length does not fit")
    block = data[start:stop]
    name, _, digest = headers.get("warc-block-digest", "").partition(":")
    if name == "sha1" and digest != hashlib.sha1(block).hexdigest():
        raise Damaged("block digest differs")
    return headers, block, stop + 4


_SIGN = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def salvage(data: bytes) -> Iterator[tuple]:
    """``('record', offset, length, headers, block)`` and ``('gap', offset, length, reason, None)``."""
    yield from _walk(data, memoryview(data), 0, None)


def _walk(data: bytes, view: memoryview, base: int, outer: int | None) -> Iterator[tuple]:
    """Records of ``data``; within a member all carry the member's offset ``base`` and length ``outer``."""
    pos, bad, reason = 0, None, ""
    while pos < len(data):
        try:
            if outer is None and data.startswith(b"\x1f\x8b", pos):
                inner, end = inflate(view, pos)
                found = list(_walk(inner, memoryview(inner), pos, end - pos))
                if not any(kind == "record" for kind, *_ in found):
                    raise Damaged(found[0][3] if found else "empty member")
            else:
                headers, block, end = parse_record(data, pos)
                found = [("record", pos if outer is None else base, end - pos if outer is None else outer,
                          headers, block)]
        except Damaged as e:
            sign = _SIGN.search(data, pos + 1)
            after = sign.start() if sign else len(data)
            # A member that breaks off: its whole records first, the rest of its content is the gap.
            held = list(_walk(e.content, memoryview(e.content), pos, after - pos)) if e.content and outer is None else []
            if any(kind == "record" for kind, *_ in held):
                if bad is not None:
                    yield _gap(bad, pos, reason, base, outer)
                    bad = None
                for _, offset, length, headers, block in (x for x in held if x[0] == "record"):
                    # No check covers headers but the member's own: a payload digest that fits speaks for them.
                    if headers.get("warc-type") != "response" or _payload_fits(headers, block):
                        yield "record", offset, length, headers | {"x-salvaged": str(e)}, block
                lost = [x[3] for x in held if x[0] == "gap"] or ["all of its records whole"]
                yield "gap", pos, after - pos, "; ".join([str(e), *lost]), None
            elif bad is None:
                bad, reason = pos, str(e)
            pos = after
            continue
        if bad is not None:
            yield _gap(bad, pos, reason, base, outer)
            bad = None
        yield from found
        pos = end
    if bad is not None:
        yield _gap(bad, len(data), reason, base, outer)


def _gap(start: int, end: int, reason: str, base: int, outer: int | None) -> tuple:
    if outer is None:
        return "gap", start, end - start, reason, None
    return "gap", base, outer, f"{reason} (bytes {start} to {end} of the member's content)", None


def _row_id(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-row:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP headers of a response's block."""
    if headers.get("warc-type") != "response":
        return block
    _, blank, payload = block.partition(b"\r\n\r\n")
    return payload if blank else block


def _payload_fits(headers: dict[str, str], block: bytes) -> bool:
    name, _, digest = headers.get("warc-payload-digest", "").partition(":")
    return name != "sha1" or digest == hashlib.sha1(payload_of(headers, block)).hexdigest()


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the archives in a folder.

    ``kind`` is ``record`` or ``gap``; a gap has its file, offset, length and
    reason.  A record that was recovered from a damaged member has the damage as
    its reason.  Digest and length of a response are those of the bytes read;
    those of a revisit are what its headers say of the full payload.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path)
    schema = StructType.fromDDL(PAYLOAD_SCHEMA if payloads else RECORD_SCHEMA)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, held = batch.column(0)[i].as_py(), [], 0
                for kind, offset, length, what, block in salvage(batch.column(1)[i].as_py()):
                    if kind == "gap":
                        rows.append((name, offset, length, kind, what) + (None,) * (len(arrow) - 5))
                        continue
                    payload = payload_of(what, block)
                    revisit = what.get("warc-type") == "revisit"
                    size = what.get("x-payload-length", "")
                    row = (name, offset, length, kind, what.get("x-salvaged"), _row_id(what.get("warc-record-id")),
                           what.get("warc-type"), what.get("warc-target-uri"),
                           (int(size) if size.isdecimal() else None) if revisit else len(payload),
                           what.get("warc-payload-digest", "").rpartition(":")[2] if revisit
                           else hashlib.sha1(payload).hexdigest(), _row_id(what.get("warc-refers-to")))
                    rows.append(row + (payload,) if payloads else row)
                    held += len(block) if payloads else 0
                    if held > CHUNK * 64 or len(rows) >= 10_000:
                        yield _batch(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, arrow)

    return files.select("path", "content").mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], names=arrow.names)
