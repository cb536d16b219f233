"""Token counts against the library itself; what the cache holds and what is encoded."""
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from webfoot.llm import bytebpe, queries, tokencount
from webfoot.session import scratch_path

SF = "/root/testdata/sf0.001"


def library(vocabulary=None):
    vocabulary = vocabulary or tokencount.default_vocabulary()
    if vocabulary.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        return lambda t: len(model.encode(t or ""))
    from tokenizers import Tokenizer
    held = Tokenizer.from_file(vocabulary)
    return lambda t: len(held.encode(t or "", add_special_tokens=False).ids)


def expected(rows, count):
    return sorted(((i, len((t or "").encode()), count(t), count(t) > 1024) for i, t in rows), key=repr)


def counted(df, cache, **more):
    return sorted(map(tuple, tokencount.token_counts(df, cache, **more).collect()), key=repr)


ODD = ["", None, " ", "a  b\t\n c", "x<|endoftext|>y", " <|endoftext|> ", "é日本\U0001f600 　z", "don't we'll", "a\x00b", "́ e",
       "naïve Ærø x\u0301y 日本 plain words, then ½ odd\u00a0ones \x1c\x1f end", "a" * 70 + "\n\n  <|endoftext|>\n  b",
       "word " * 60_000, "x" * 150_000, "1 " * 50_000 + "<|endoftext|>" * 9000 + " \n \n" * 9000, "one"]


def test_query_against_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_token_counts(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, library())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_odd_texts_with_each_library(spark, name):
    vocabulary = public_tokenizers.path(name)
    texts = [t if name.startswith("byte") or t is None else t[:20_000] for t in ODD]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (3, "other"), (None, "one"), (None, "one"), (None, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string").repartition(4)
    assert counted(df, scratch_path(spark, "cache"), vocabulary=vocabulary) == expected(rows, library(vocabulary))


def test_only_distinct_misses_are_encoded_and_appended(spark, monkeypatch):
    cache, version = scratch_path(spark, "cache"), tokencount.version_digest(tokencount.default_vocabulary())
    first = [(i, f"text number {i % 50}") for i in range(300)] + [(None, "nobody")] * 40
    more = first + [(1000 + i, f"more {i // 3}") for i in range(30)]
    encoded = []
    true = tokencount.encode

    def watched(rows, vocabulary):
        encoded.append(sorted(r.text for r in rows.collect()))
        return true(rows, vocabulary)

    monkeypatch.setattr(tokencount, "encode", watched)
    schema = "doc_id long, text string"
    assert counted(spark.createDataFrame(first, schema), cache) == expected(first, library())
    assert len(encoded[0]) == 50 + 40 and set(encoded[0]) == {t for _, t in first}  # rows without an id stand for themselves
    assert counted(spark.createDataFrame(more, schema), cache) == expected(more, library())
    assert encoded[1] == sorted({f"more {i}" for i in range(10)})
    assert counted(spark.createDataFrame(more, schema), cache) == expected(more, library()) and len(encoded) == 2
    held = spark.read.parquet(cache)
    assert held.count() == held.select("digest").distinct().count() == 51 + 10
    assert {r.version for r in held.collect()} == {version}
    # A repeated append changes nothing, another version shares nothing.
    tokencount.append_counts(held.where(F.col("version") == version).select("digest", "n_tokens"), cache, version)
    assert counted(spark.createDataFrame(more, schema), cache) == expected(more, library()) and len(encoded) == 2
    other = public_tokenizers.path("word_bpe_49k.json")
    assert counted(spark.createDataFrame(first, schema), cache, vocabulary=other) == expected(first, library(other))
    assert len(encoded) == 3


def test_stored_counts_are_used(spark):
    cache, version = scratch_path(spark, "cache"), tokencount.version_digest(tokencount.default_vocabulary())
    known = spark.createDataFrame([("known",)], "t string").select(F.unhex(F.sha2("t", 256)).alias("digest"), F.lit(4711).cast("long").alias("n_tokens"))
    tokencount.append_counts(known, cache, version)
    df = spark.createDataFrame([(1, "known"), (2, "new"), (3, "known")], "doc_id long, text string")
    assert counted(df, cache) == [(1, 5, 4711, True), (2, 3, library()("new"), False), (3, 5, 4711, True)]


def test_spellings_of_one_normal_form_share_an_entry(spark):
    vocabulary, cache = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "cache")
    rows = [(1, "Two  Words"), (2, "two words"), (3, "TWO\nWORDS"), (4, "<|endoftext|>"), (5, "<|ENDOFTEXT|>")]
    assert counted(spark.createDataFrame(rows, "doc_id long, text string"), cache, vocabulary=vocabulary) == expected(rows, library(vocabulary))
    assert spark.read.parquet(cache).count() == 3


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(tokencount, "PAGE", 8)
    monkeypatch.setattr(tokencount, "MAX_PLACES", 8)
    monkeypatch.setattr(tokencount, "HOT", 3)
    rows = [(i, f"t {i % 7} {'x' * (i % 3)}") for i in range(100)]
    assert counted(spark.createDataFrame(rows, "doc_id long, text string"), scratch_path(spark, "cache")) == expected(rows, library())


def test_empty_table(spark):
    cache = scratch_path(spark, "cache")
    empty = spark.createDataFrame([], "doc_id long, text string")
    got = tokencount.token_counts(empty, cache)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == 0
    assert tokencount.stored_counts(spark, cache, tokencount.version_digest(tokencount.default_vocabulary())) is None


def test_parts_join_to_the_text():
    for text in ("a b " * 50_000, "x" * 200_000, "", "ab \n" * 40_000):
        cut = bytebpe.parts(text)
        assert "".join(cut) == text and all(len(p) >= bytebpe.PART_CHARS for p in cut[:-1])


def test_any_text_counts_as_the_library_counts_it():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    count, plain = tokencount.counter(tokencount.default_vocabulary()), library()
    pieces = st.sampled_from(["a", "Word", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "日", "'s", "'", "42", ".", "…", "\x85", "\u3000", "\x1c", "<|endoftext|>",
                              "<|", "\u0301", "½", "٣", "\U0001f600", "x" * 40])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(pieces | st.characters(codec="utf-8"), max_size=30).map("".join))
    def check(text):
        assert count([text]) == [plain(text)]
    check()
