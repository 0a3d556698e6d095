"""The registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakeveil.llm import alignment, exact_dedup, line_dedup, manifest, mixing, mixing_lm, near_dup, pieces, pseudonyms
from lakeveil.llm import quality, secrets, suffix_dedup, toxicity
from lakeveil.llm.common import documents
from lakeveil.llm.line_dedup import lower_ascii
from lakeveil.llm.oracles import LINE_ORACLE, manifest_oracle
from lakeveil.llm.parameters import BYTE_MODEL, PSEUDONYM_KEY, labels, tokenizer_model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query()
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_size", "kept")


@query()
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shard", "place")


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(documents(spark, sf_dir), labels(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "content_share")


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encoded(documents(spark, sf_dir), tokenizer_model())
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")


@query(
    """select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(documents(spark, sf_dir), PSEUDONYM_KEY).select("doc_id", "text", "n_values", "kinds")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(documents(spark, sf_dir), labels(spark, sf_dir))
    return found.select("doc_id", "held_out", "score", "predicted")


@query()
def op10_context_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing_lm.scored(documents(spark, sf_dir))
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    return found.select("doc_id", "held_out", *names)


@query()
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned(documents(spark, sf_dir), tokenizer_model(BYTE_MODEL), tokenizer_model())
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return found.select("doc_id", *counts, "groups_sha256")


@query(manifest_oracle())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third checksum's row is presented with a tampered text."""
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    claimed = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest.manifest(documents(spark, sf_dir), claimed)


@query(LINE_ORACLE)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
