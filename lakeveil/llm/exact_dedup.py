"""Exact dedup as a stateful stream.

A narrow feed (digest, doc_id, locator) is streamed into an aggregation keyed by digest. Its state
lives in RocksDB on the executors' disks and in the shared checkpoint folder, has no watermark and
so never expires: per digest the number of rows and the keeper, i.e. the largest doc_id with the
locator of its content. A digest hit is not trusted: the full texts of the hits are compared with the
keeper's, and digests under which texts differ are grouped again by the texts themselves.

The partial aggregation in front of the state's shuffle turns a text that holds a third of all rows
into one row per task; the comparison is a sort-merge join, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.llm.common import FILE, POS, ROW, landed, located, only, text_of
from lakeveil.sources.workspace import new_folder, stored

_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state."
    "RocksDBStateStoreProvider",
    # Block cache and write buffers of all partitions of an executor together.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    # Without it every partition's store takes some 4 MB of disk in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def feed_of(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(locator, doc_id, digest) of every row."""
    return located(docs, F.col("doc_id").alias("id"), digest(text_of()).alias("digest"))


def fold(spark: SparkSession, feed_path: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """Stream what is new in the feed's folder into the state; may be called again as files arrive."""
    reader = spark.readStream.schema(spark.read.parquet(feed_path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    groups = (
        reader.parquet(feed_path)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", FILE, POS)).alias("keeper"))
    )
    before = {k: spark.conf.get(k, None) for k in _STATE_SETTINGS}
    try:
        for key, value in _STATE_SETTINGS.items():
            spark.conf.set(key, value)
        query = (
            groups.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def groups_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, group_size, keep_id, keep_file, keep_pos) as the state holds them."""
    state = spark.read.format("statestore").load(checkpoint)
    size, keeper = state.schema["value"].dataType.names
    keep = F.col(f"value.`{keeper}`")
    return state.select(
        "key.digest",
        F.col(f"value.`{size}`").alias("group_size"),
        keep.getField("id").alias("keep_id"),
        keep.getField(FILE).alias("keep_file"),
        keep.getField(POS).alias("keep_pos"),
    )


def exact_dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None
) -> DataFrame:
    """(locator, doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of equal texts the row with the largest doc_id stays; a null doc_id ranks last, and of repeated
    rows with one doc_id exactly one stays. Null texts count as empty, and empty texts are equal. An
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    docs = landed(docs)
    feed_path = new_folder(spark, "dedup-feed")
    feed_of(docs, digest).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    checkpoint = new_folder(spark, "dedup-state")
    fold(spark, feed_path, checkpoint, files_per_batch)
    groups = stored(groups_of(spark, checkpoint), "dedup-groups")

    mixed = stored(_mixed_digests(docs, groups, digest), "dedup-mixed")
    members = feed.join(groups.hint("merge"), "digest")
    sure = members
    if not mixed.isEmpty():
        sure = members.join(mixed.hint("merge"), "digest", "left_anti")
    sha = F.lower(F.hex("digest"))
    if digest is not sha256:
        full = located(docs, F.sha2(text_of(), 256).alias("text_sha256"))
        sure, sha = sure.join(full.hint("merge"), ROW), F.col("text_sha256")
    kept = (F.col(FILE) == F.col("keep_file")) & (F.col(POS) == F.col("keep_pos"))
    result = sure.select(
        *ROW, F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), sha.alias("text_sha256")
    )
    return result if mixed.isEmpty() else result.union(_grouped_by_text(docs, mixed, digest))


def _texts(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return located(docs, F.col("doc_id").alias("id"), digest(text_of()).alias("digest"), text_of().alias("body"))


def _mixed_digests(docs: DataFrame, groups: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests under which some text differs from the keeper's, every byte compared."""
    hits = groups.where("group_size > 1").select("digest", "keep_file", "keep_pos")
    keeper = (F.col(FILE) == F.col("keep_file")) & (F.col(POS) == F.col("keep_pos"))
    # Written once and read twice, as hits and as keepers.
    found = _texts(docs, digest).drop("id").join(hits.hint("merge"), "digest")
    found = stored(found.select("digest", "body", keeper.alias("keeper")), "dedup-hits")
    keepers = found.where("keeper").select("digest", F.col("body").alias("keeper_body"))
    others = found.where("NOT keeper").join(keepers.hint("merge"), "digest")
    return others.where("body <> keeper_body").select("digest").distinct()


def _grouped_by_text(docs: DataFrame, mixed: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    rows = _texts(docs, digest).join(mixed.hint("merge"), "digest", "left_semi")
    groups = rows.groupBy("body").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", *ROW)).alias("keep"))
    kept = (F.col(FILE) == F.col(f"keep.{FILE}")) & (F.col(POS) == F.col(f"keep.{POS}"))
    return rows.join(groups.hint("merge"), "body").select(
        *ROW,
        F.col("id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        kept.alias("kept"),
        F.sha2("body", 256).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text."""
    docs = landed(docs)
    return only(docs, exact_dedup(docs).where("kept"))
