"""Corpus pipeline: documents in, packed training sequences out.

Five stages, each one operator over all rows that the stage before it kept:
importance resampling drops what it rejects, the n-gram Jaccard join leaves
one document of each near-duplicate group, suffix-array dedup cuts repeated
passages, the secret scan replaces secrets, and packing tokenises the rest
into sequences.  All stages but the last return the columns of ``documents``;
``n_chars`` follows the text.  ``run`` writes every stage as Parquet in the
shared checkpoint folder and reads it back, so a lost executor costs at most
the stage at hand.

Defined cases are the operators'; a text that is cut to nothing stays as an
empty document, a null text stays null up to packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import jaccard, packing, resampling, secrets, suffix_dedup
from stratiform.llm.common import table
from stratiform.session import checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resampling.sampled(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(suffix_dedup.without_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, least = secrets.scan(docs)
    return _counted(secrets.redact(docs, least))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan),
    ("packing", pack_sequences),
]

#: Hashed models, components and token ids are beyond SQL; tests compare with
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
