"""A corpus pipeline of five stages over ``documents``, each on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areakit.llm import jaccard, mixing, pieces, quality, substrings
from areakit.llm.common import documents, labels
from areakit.session import settle

# Near copies: five-word shingles, Jaccard similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY = (80, 100)

# No SQL: the first stage scores with a network that it fits.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality network rejects."""
    return quality.good_documents(docs, labels(spark, sf_dir))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays."""
    joined = jaccard.join_documents(docs, SHINGLE_WORDS, SIMILARITY)
    # Repeated rows of an id go together, and only if none is its component's first.
    gone = joined.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("component_id")).alias("gone")).filter("gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id has; documents left empty go."""
    return substrings.cut_documents(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with digests of ids and decoded text."""
    encoded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", keep_one_of_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("source_mixing", mix_to_weights),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each one's result written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
