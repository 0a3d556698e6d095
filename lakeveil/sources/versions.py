"""Replacing the data of a table or of one partition without a gap.

The new rows are written to a folder of their own, and one change of the catalogue, ``SET LOCATION``, puts that
folder in place. Readers find the old rows until then and the new ones afterwards; a load that fails before it has
changed nothing. The version before the current one stays for readers that are under way, older ones are removed.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from lakeveil.functions.sqltext import string

# Marks a table's first folder, where the catalogue would put a new table of that name, once it isn't the table's any more.
_SUPERSEDED = "_superseded"
_VERSION = re.compile(r"(.*)__v(\d+)-[0-9a-f]{32}")


def details(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """What the catalogue says about a table, or the partition of it that the clause names, beside its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}{partition}").collect()
    start = next(i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed"))
    found: dict[str, str] = {}
    for row in rows[start + 1 :]:
        found.setdefault(row.col_name, row.data_type)
    return found


def location(spark: SparkSession, table: str, partition: str = "") -> str:
    return details(spark, table, partition)["Location"].rstrip("/")


def _next(current: str, base: str) -> tuple[str, str | None]:
    """(the next version's folder, a pattern of the folder before the current one)."""
    match = _VERSION.fullmatch(current)
    number = int(match[2]) if match else 0
    before = [None, base][number] if number < 2 else f"{base}__v{number - 1}-*"
    return f"{base}__v{number + 1}-{uuid.uuid4().hex}", before


def _path(spark: SparkSession, name: str):
    """(Hadoop's path, its file system)"""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, pattern: str | None) -> None:
    if pattern is None:
        return
    path, system = _path(spark, pattern)
    for found in system.globStatus(path) or []:
        system.delete(found.getPath(), True)


def clear_superseded(spark: SparkSession, table: str) -> None:
    """Remove what a dropped table's first version left at the place where a new table of that name would go."""
    namespace, _, name = table.rpartition(".")
    rows = spark.sql(f"DESCRIBE NAMESPACE {namespace or 'default'}").where("info_name = 'Location'").collect()
    base = f"{rows[0].info_value.rstrip('/')}/{name.strip('`').lower()}"
    marker, system = _path(spark, f"{base}/{_SUPERSEDED}")
    if system.exists(marker):
        _remove(spark, base)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all versions of its data."""
    current = location(spark, table)
    match = _VERSION.fullmatch(current)
    spark.sql(f"DROP TABLE {table}")
    for pattern in [match[1], f"{match[1]}__v*"] if match else []:
        _remove(spark, pattern)


def replace_table(df: DataFrame, table: str, table_format: str) -> None:
    """The rows of ``df``, which may be derived from the table, in place of those of a table with the same columns."""
    spark = df.sparkSession
    current = location(spark, table)
    match = _VERSION.fullmatch(current)
    folder, old = _next(current, match[1] if match else current)
    df.write.format(table_format).save(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {string(folder)}")
    spark.catalog.refreshTable(table)
    if match is None:
        marker, system = _path(spark, f"{current}/{_SUPERSEDED}")
        system.create(marker).close()
    _remove(spark, old)


def replace_partition(df: DataFrame, table: str, column: str, value: str, table_format: str) -> None:
    """The rows of ``df``, which may be derived from the table, in place of those of one partition; the others stay."""
    spark = df.sparkSession
    clause = f" PARTITION ({column} = {string(value)})"
    base = f"{location(spark, table)}__{hashlib.md5(value.encode()).hexdigest()[:12]}"
    known = spark.sql(f"SHOW PARTITIONS {table}{clause}").count() > 0
    current = location(spark, table, clause) if known else base
    folder, old = _next(current, base)
    df.drop(column).write.format(table_format).save(folder)
    if known:
        spark.sql(f"ALTER TABLE {table}{clause} SET LOCATION {string(folder)}")
    else:
        spark.sql(f"ALTER TABLE {table} ADD{clause} LOCATION {string(folder)}")
    spark.catalog.refreshTable(table)
    _remove(spark, old)
