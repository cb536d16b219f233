"""A pipeline over ``documents``: each stage works on all that the one before it kept.

Toxic documents go; of near-duplicates one document of each group stays;
personal data gets surrogates; sources are mixed to target weights (the rows'
order is the mixture's); the mixture is packed into sequences, in that order.

Every stage is written as Parquet and read again, so a stage that fails is
repeated from its predecessor's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webfoot.llm import mixing, neardup, packing, pii, toxicity
from webfoot.llm.common import materialize, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, unchanged."""
    return toxicity.clean(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8)."""
    return neardup.one_of_each(docs, k=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with surrogates for personal data; ``n_chars`` follows the text."""
    return pii.replace_entities(docs, length_col="n_chars", add=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture."""
    return mixing.in_order(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, filled in the order of the documents."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned, the MinHash, the keyed and the tokenizing stage are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier stage is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
