"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfoot.llm import (licenses, merkle, mixing, neardup, packing, pii, repetition, tokencount, topk, toxicity, urlrules, warc,
                         whitening)
from webfoot.llm.common import col, lower_az, read
from webfoot.session import scratch_path

#: (verdict, host, path)
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.license_scan(docs, keep=["doc_id"]).drop("matches")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, lambda vec_id: vec_id % 100 == 0)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, k=4)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge(pages, urlrules.rule_table(spark, URL_RULES), keep=["page_id"])


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.read_archives(spark, path, payloads=False).where("kind = 'record'").select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.repetition(docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return pii.replace_entities(docs, length_col="n_chars")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, scratch_path(spark, "token-cache"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.proofs(merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                                         changed={"text": lower_az(col("text"))}, where=tampered))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_license_scan, op3_toxicity, op4_top_k, op5_near_duplicates, op6_url_filter, op7_warc, op8_packing, op9_repetition, op10_surrogates,
                                  op11_token_counts, op12_whitening, op13_merkle)}
