"""The training-data pipeline: quality rules, exact dedup, near-dedup, mixing by source, tokens.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a frame that is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeveil.llm import exact_dedup, mixing, near_dup, pieces, quality
from lakeveil.llm.common import documents
from lakeveil.llm.parameters import labels, tokenizer_model
from lakeveil.sources.workspace import intermediates, new_folder, stored_at


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the counts and have enough content; without words none does."""
    return quality.keep_good(docs, labels(spark, sf_dir))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id."""
    return near_dup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix draws: a document drawn twice has two rows, a part drawn is a shorter text."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row."""
    found = pieces.encoded(docs, tokenizer_model(), ids=True)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("source mixing", source_mix),
    ("sentencepiece", token_ids),
]

# Hash-based permutations, signatures, a fitted model and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Every stage's result stays in the shared folder, what it stored on its way does not.

    Repeated rows are copies that exact dedup removes; an empty table goes through all stages and gives no rows.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        target = new_folder(spark, name.replace(" ", "-"))
        with intermediates(spark):
            docs = stored_at(stage(spark, docs, sf_dir), target)
    return docs
