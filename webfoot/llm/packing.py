"""Harmonic packing of token ids into sequences of a fixed capacity.

A document is its token ids and one end id.  It is cut into full sequences,
then into pieces whose lengths are reciprocals of the capacity (1/2, 1/4, ...
down to ``SMALLEST_UNIT``), and a tail shorter than that.  All pieces of one
length form a class, and each bin of a class holds a fixed number of them:
``capacity // length``.  The reciprocal classes fill their bins exactly; a
tail bin wastes less than one tail.

Workers fill bins independently: a task numbers its pieces within each class
(per input split), Spark sums the splits' counts, and a piece's bin and offset
follow from the running count of its class and its own number.  So a bin may
span two splits and only the last bin of a class is partial.  Those last bins
hold at most ``capacity // length - 1`` pieces for each of at most
``SMALLEST_UNIT + log2(capacity)`` lengths, whatever the input (some 10,000
short pieces for 2048): this bounded rest is packed by first fit.

Splits are numbered by file and offset, so documents written in a chosen order
are packed in that order.  Pieces are written to the shared folder before they
are counted; the numbering never changes when a task runs again.

Token ids come from a public byte-level BPE vocabulary (its file is a
parameter).  No token spans the start of a run of blanks after a letter, so
long texts are encoded in parts; parts of common characters go through a faster
library with the same merges, all others through the vocabulary's own.

Defined cases: null and empty texts hold the end id only; rows with null or
repeated ids are packed like any other; strings that look like special tokens
are ordinary text; an empty table gives an empty result; other columns are
not carried.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfoot.llm.bytebpe import merges_of, parts, runs
from webfoot.llm.common import col, lean, materialize, text_slices

CAPACITY = 2048
SMALLEST_UNIT = 64
END_ID = 1


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts as little-endian 16-bit bytes."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        held = Tokenizer.from_file(vocabulary)
        held.encode_special_tokens = True
        if held.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self._tokenizer = held
        self._merges = merges_of(held, [t.content for t in held.get_added_tokens_decoder().values()])

    def __call__(self, text: str) -> bytes:
        out = []
        for part in parts(text):
            for plain, piece in runs(part):
                ids = (self._merges(piece) if plain and self._merges else
                       self._tokenizer.encode(piece, add_special_tokens=False).ids)
                out.append(np.array(ids, "<u2").tobytes())
        return b"".join(out)


def cut_lengths(n: int, capacity: int = CAPACITY, unit: int = SMALLEST_UNIT) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    full, rest = divmod(n, capacity)
    lengths, size = [capacity] * full, capacity // 2
    while size >= unit:
        if rest >= size:
            lengths.append(size)
            rest -= size
        size //= 2
    return lengths + [rest] * (rest > 0)


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int, unit: int,
           end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece, with its split and its number among the split's pieces of that length."""
    source = docs.select(
        F.concat_ws("#", F.input_file_name(), F.lpad(F.input_file_block_start().cast("string"), 20, "0")).alias("at"),
        col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    names = ["split", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "number"] + ["ids"] * with_ids

    def run(batches):
        from pyspark import TaskContext
        task = f"#{TaskContext.get().partitionId():08d}"
        encode, end = Encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        split, numbers = None, None
        for batch, texts in text_slices(batches, 2):
            out = [[] for _ in names]
            for at, doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                if at != split:
                    split, numbers = at, defaultdict(int)
                ids = encode((raw or b"").decode("utf-8", "replace"))
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes() + end
                total, start = len(wide) // 4, 0
                for length in cut_lengths(total, capacity, unit):
                    held = wide[4 * start:4 * (start + length)]
                    row = (split + task, doc_id, start, length, zlib.crc32(held), total, numbers[length])
                    for column, value in zip(out, row + (held,) if with_ids else row):
                        column.append(value)
                    numbers[length] += 1
                    start += length
            types = [pa.string()] + [pa.int64()] * 6 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    schema = ("split string, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, number long"
              + ", ids binary" * with_ids)
    return source.mapInArrow(lean(run), schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         capacity: int = CAPACITY, unit: int = SMALLEST_UNIT, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit bytes.
    """
    if capacity & (capacity - 1) or unit & (unit - 1) or not 0 < unit <= capacity:
        raise ValueError("capacity and smallest unit must be powers of two")
    held = materialize(pieces(docs, id_col, text_col, vocabulary or default_vocabulary(), capacity, unit,
                              end_id, with_ids), "pieces")
    counts = held.groupBy("split", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most `unit + log2(capacity)` lengths: each window holds one row per split.
    before = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("split", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    base, full, rows = 0, {}, counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("length")).collect()
    for r in rows:
        bins = r["n"] // (capacity // r["length"])
        full[r["length"]] = (base, bins)
        base += bins
    if not full:
        return held.drop("split", "number").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    classes = F.create_map(*[x for k, (b, n) in full.items() for x in (
        F.lit(k), F.struct(F.lit(b).cast("long").alias("base"), F.lit(n).cast("long").alias("bins")))])
    per_bin = F.floor(F.lit(capacity) / F.col("length"))
    placed = (held.join(offsets, ["split", "length"])
              .withColumn("rank", F.col("before") + F.col("number")).withColumn("class", classes[F.col("length")])
              .withColumn("bin", F.floor(F.col("rank") / per_bin)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    filled = placed.where("bin < class.bins").select(
        *columns, (F.col("class.base") + F.col("bin")).alias("sequence_id"),
        ((F.col("rank") % per_bin) * F.col("length")).alias("offset"))
    rest = placed.where("bin >= class.bins").select(*columns, F.col("rank"), F.lit(0).alias("one"))
    schema = filled.schema

    def first_fit(frame):
        frame = frame.sort_values(["length", "rank"], ascending=[False, True], kind="stable")
        used, ids, offsets = [], [], []
        for length in frame["length"]:
            at = next((i for i, n in enumerate(used) if n + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            ids.append(base + at)
            offsets.append(used[at])
            used[at] += length
        return frame.assign(sequence_id=ids, offset=offsets)[columns + ["sequence_id", "offset"]]

    return filled.unionByName(rest.groupBy("one").applyInPandas(first_fit, schema))
