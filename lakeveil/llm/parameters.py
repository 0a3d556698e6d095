"""Where the operators' queries and the pipeline find labels and vocabularies."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"
# For the registered query only; a real key is a secret and comes from outside.
PSEUDONYM_KEY = "registered query"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def tokenizer_model(name: str = PIECE_MODEL) -> str:
    return public_tokenizers.path(name)
