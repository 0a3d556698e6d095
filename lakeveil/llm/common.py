"""Pieces the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeveil.llm
from lakeveil.sources.workspace import stored

# Functions of this package travel to the executors by value: they need not have it installed.
cloudpickle.register_pickle_by_value(lakeveil.llm)

# Fixed value: what counts as a word, the same in Java, Python and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
# The locator of a row: a digest of its file's path, and its place in that file.
FILE, POS = "lv_file", "lv_pos"
ROW = [FILE, POS]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def located(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of every row with its locator, which is the same in every read.

    A frame that isn't a scan of files is written to the shared folder first.
    """
    locator = [F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(POS)]
    if "_metadata" not in docs.columns:
        try:
            return docs.select(*locator, *columns)
        except AnalysisException as error:
            if error.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION"):
                raise
    return stored(docs, "landed").select(*locator, *columns)


def landed(docs: DataFrame) -> DataFrame:
    """``docs`` itself if it is a scan of files, else a stored copy of it: ``located`` finds the same rows in both."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return stored(docs, "landed")


def only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` (as ``landed`` returned them) whose locators are in ``rows``, with their own columns."""
    names = docs.columns
    found = located(docs, *[F.col(f"`{n}`").alias(f"lv_c{i}") for i, n in enumerate(names)])
    found = found.join(rows.select(*ROW).hint("merge"), ROW, "left_semi")
    return found.select(*[F.col(f"lv_c{i}").alias(n) for i, n in enumerate(names)])


def sampled(docs: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """(locator, columns of ``known``) of at most ``limit`` rows of ``docs`` (as ``landed`` returned them) that meet
    ``known`` by doc_id: those with the smallest hashes of id and text. Rows with equal ids and texts count as one."""
    rows = located(docs, "doc_id", F.sha2(text_of(), 256).alias("lv_digest")).where("doc_id IS NOT NULL")
    rows = rows.groupBy("doc_id", "lv_digest").agg(F.min(F.struct(*ROW)).alias("lv_at"))
    rows = rows.join(known.hint("merge"), "doc_id")
    names = [c for c in known.columns if c != "doc_id"]
    order = [F.xxhash64("doc_id", "lv_digest"), "doc_id", "lv_digest", *names]
    return rows.orderBy(*order).limit(limit).select("lv_at.*", *names)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
