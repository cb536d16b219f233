"""Token counts with a digest cache.

A count is a fact about a text and a tokenizer, so it is kept under two
digests: that of the text's normal form and that of the tokenizer's version
(library, release and vocabulary file).  Counting a table is a join of its
digests to the stored counts; only distinct texts that miss are encoded, and
their counts are appended to the cache.

The normal form is the text after the vocabulary's own normalizer, so spellings
that the tokenizer cannot tell apart share an entry; a text that holds one of
the added special strings is kept as it is, since these are found before the
normalizer runs.

Which rows are encoded is decided on digests alone.  Of each missing text the
row with the smallest id stands for all.  A row learns its part from two
bitmaps, one bit a digest place, built by Spark and broadcast (``PLACES_PER_TEXT``
places a text, at most ``MAX_PLACES``, so 32 MB): places of missing texts, and
places of texts that are stored or stand in several rows.  A place without the
first is a hit.  With the first and without the second it is a text of this row
alone, encoded where it is read.  Only rows with both meet the exact list of
representatives by a join on digest and id, which is the one place where texts
move.  Larger tables fill the bitmaps, which sends more rows through that join
and changes no result.

Counts come back by a join on the digest; texts with more than ``1 / HOT`` of the
rows (``HOT`` at most, so always broadcast) are joined apart, so no digest's rows
meet in one task.

The cache is a Parquet folder partitioned by version.  Entries never change, so
an append that was repeated or ran beside another only repeats rows, which
reading merges; an append that failed leaves nothing or whole entries.

Defined cases: null texts count as empty; rows with null or repeated ids are
counted like any other (rows that repeat an id and a text may be encoded once a
task); special strings inside texts count as the library's default has it;
texts of any length are encoded whole, long ones in parts that no token spans;
of byte-level vocabularies whose ids follow their merges, parts of common
characters are counted by a faster library with the same merges;
an empty table gives an empty result and adds nothing; other columns are not
read.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webfoot.llm.bytebpe import CUT, PART_CHARS, merges_of, parts, runs
from webfoot.llm.common import col, discard, materialize, text_slices

LIMIT = 1024
HOT = 500
PLACES_PER_TEXT = 8
MAX_PLACES = 1 << 27
PAGE = 1 << 15  # places of one bitmap row
SEEN = 100_000  # digests a task remembers

def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    held = Tokenizer.from_file(vocabulary)
    held.no_truncation()
    held.no_padding()
    return held


def _special(held) -> list[str]:
    return [t.content for t in held.get_added_tokens_decoder().values()]


def version_digest(vocabulary: str) -> str:
    """The digest of the tokenizer's library, its release and the vocabulary file."""
    if vocabulary.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(vocabulary, "rb") as f:
        return sha256(f"{library.__name__} {library.__version__}\n".encode() + f.read()).hexdigest()


def normal_form(vocabulary: str) -> Callable[[str], str] | None:
    """The text as the tokenizer sees it, None where that is the text itself."""
    if vocabulary.endswith(".model"):
        return None
    held = _tokenizer(vocabulary)
    if held.normalizer is None:
        return None
    special = _special(held)

    def normal(text: str) -> str:
        if any(s in text for s in special):
            return "\x00as is\x00" + text
        return held.normalizer.normalize_str(text)
    return normal


@lru_cache(2)
def counter(vocabulary: str) -> Callable[[list[str]], list[int]]:
    """A function from whole texts to their numbers of tokens."""
    if vocabulary.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        return lambda texts: [len(model.encode(t, out_type=int, add_bos=False, add_eos=False)) for t in texts]
    held = _tokenizer(vocabulary)
    before, added = held.pre_tokenizer, list(held.get_added_tokens_decoder().values())
    special = [t.content for t in added]
    # Parts count alike only where neither a normalizer nor a prefix looks at a part's edges.
    divisible = (held.normalizer is None and type(before).__name__ == "ByteLevel" and not before.add_prefix_space
                 and before.use_regex and not any(t.lstrip or t.rstrip or t.single_word or CUT.search(t.content) for t in added))
    merges = merges_of(held, special) if divisible else None

    def by_library(pieces: list[str]) -> int:
        total = start = size = 0
        for end, p in enumerate(pieces, 1):
            size += len(p)
            if size >= PART_CHARS or end == len(pieces):
                total += sum(map(len, held.encode_batch_fast(pieces[start:end], add_special_tokens=False)))
                start, size = end, 0
        return total

    def of_part(part: str) -> int:
        if any(s in part for s in special):
            return by_library([part])
        total, odd = 0, []
        for plain, piece in runs(part):
            if plain:
                total += len(merges(piece))
            else:
                odd.append(piece)
        return total + by_library(odd)

    if not divisible:
        return lambda texts: [by_library([t]) for t in texts]
    if merges is None:
        return lambda texts: [by_library(parts(t)) for t in texts]
    return lambda texts: [sum(map(of_part, parts(t))) for t in texts]


def with_digest(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, texts: bool) -> DataFrame:
    """``(id, digest, n_bytes)`` of each row, and its ``text``."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(col(id_col).cast("long").alias("id"), text.alias("text"))
    kept = ["id", "digest", "n_bytes"] + ["text"] * texts
    if normal_form(vocabulary) is None:
        return rows.select("id", F.unhex(F.sha2("text", 256)).alias("digest"),
                           F.octet_length("text").cast("long").alias("n_bytes"), "text").select(*kept)

    def run(batches):
        normal = normal_form(vocabulary)
        for batch, raw in text_slices(batches, 1):
            digests = [sha256(normal(t.decode("utf-8", "replace")).encode()).digest() for t in raw]
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array([len(t) for t in raw], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(1)] * texts, names=kept)

    return rows.mapInArrow(run, "id long, digest binary, n_bytes long" + ", text string" * texts)


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """``(digest, n_tokens)`` that the cache holds for a version; None before the first append."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={version}")
    if not path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path):
        return None
    return (spark.read.schema("digest binary, n_tokens long, version string").parquet(cache)
            .where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def append_counts(counts: DataFrame, cache: str, version: str) -> None:
    counts.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)


def _place(places: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(places))


def _bitmaps(classes: DataFrame, places: int) -> DataFrame:
    """``(page, missing, other)``: places of missing texts, and of stored or repeated ones."""
    at = classes.withColumn("place", _place(places)).withColumn("page", F.floor(F.col("place") / PAGE))
    bit = F.col("place") % PAGE
    return at.groupBy("page").agg(
        F.bitmap_construct_agg(F.when(F.col("missing"), bit)).alias("missing"),
        F.bitmap_construct_agg(F.when(~F.col("missing") | (F.col("n") > 1), bit)).alias("other"))


def _is_set(bitmap: str, places: int) -> Column:
    bit = _place(places) % PAGE
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def encode(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``(digest, n_tokens)`` for ``(digest, text)``; a digest that a task has met lately is not encoded again."""
    def run(batches):
        count, seen = counter(vocabulary), set()
        for batch, raw in text_slices(batches, 1):
            digests, texts = [], []
            for digest, text in zip(batch.column(0).to_pylist(), raw):
                if digest not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(digest)
                    digests.append(digest)
                    texts.append(text.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(count(texts), pa.int64())],
                                             names=["digest", "n_tokens"])

    return rows.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def misses(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, vocabulary: str, size: int) -> DataFrame:
    """``(digest, text)`` of one row of each missing text; ``classes(digest, n, rep, missing)``, so many of them."""
    places = PAGE
    while places < min(PLACES_PER_TEXT * size, MAX_PLACES):
        places *= 2
    rows = with_digest(docs, id_col, text_col, vocabulary, True).withColumn("page", F.floor(_place(places) / PAGE))
    marked = rows.join(F.broadcast(_bitmaps(classes, places)), "page").where(_is_set("missing", places))  # 32 MB at most
    alone = marked.where(~_is_set("other", places)).select("digest", "text")
    reps = classes.where("missing").select(F.col("digest").alias("rep_digest"), "rep")
    # An inner join on keys that are unique in ``reps``: Spark would move a semi-join ahead of the bitmaps, and all texts with it.
    first = marked.where(_is_set("other", places)).select("id", "digest", "text").join(
        reps, (F.col("digest") == F.col("rep_digest")) & F.col("id").eqNullSafe(F.col("rep")))
    return alone.unionByName(first.select("digest", "text"))


def token_counts(docs: DataFrame, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row; new counts are appended to the folder ``cache``."""
    spark, vocabulary = docs.sparkSession, vocabulary or default_vocabulary()
    version = version_digest(vocabulary)
    keyed = materialize(with_digest(docs, id_col, text_col, vocabulary, False), "token-keys")
    classes = keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"))
    stored = stored_counts(spark, cache, version)
    if stored is None:
        classes = classes.withColumn("missing", F.lit(True))
    else:
        classes = classes.join(stored.select("digest", F.lit(False).alias("hit")), "digest", "left").select(
            "digest", "n", "rep", F.col("hit").isNull().alias("missing"))
    classes = materialize(classes, "token-classes")
    size, rows, missing = classes.agg(F.count(F.lit(1)), F.sum("n"), F.count_if("missing")).first()
    if missing:
        new = encode(misses(docs, classes, id_col, text_col, vocabulary, size), vocabulary)
        append_counts(new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), cache, version)
    if not size:
        return keyed.select(F.col("id").alias("doc_id"), "n_bytes", F.lit(0).cast("long").alias("n_tokens"),
                            F.lit(False).alias("over_limit"))
    counts = materialize(classes.select("digest", "n").join(stored_counts(spark, cache, version), "digest"), "token-counts")
    discard(classes)
    hot = F.broadcast(counts.where(F.col("n") * HOT >= rows).select("digest", "n_tokens"))  # HOT rows at most
    found = keyed.join(hot, "digest").unionByName(
        keyed.join(hot, "digest", "left_anti").join(counts.where(F.col("n") * HOT < rows).select("digest", "n_tokens"), "digest"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
