"""Listings of the Spark catalog as DataFrames, and loading by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.sqltext import identifier
from lakeveil.operators.profile import schema_frame


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """(namespace)"""
    where = f" IN {identifier(catalog)}" if catalog else ""
    return spark.sql(f"SHOW NAMESPACES{where}").select("namespace")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """(namespace, table_name), without temporary views."""
    return (
        spark.sql(f"SHOW TABLES IN {namespace}")
        .where(~F.col("isTemporary"))
        .select("namespace", F.col("tableName").alias("table_name"))
    )


def table_names(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(r.table_name for r in list_tables(spark, namespace).collect())


def load_table(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    return spark.table(f"{namespace}.{identifier(table)}")


def load_tables(spark: SparkSession, namespace: str) -> dict[str, DataFrame]:
    return {t: load_table(spark, namespace, t) for t in table_names(spark, namespace)}


def schema_scan(spark: SparkSession, namespace: str) -> DataFrame:
    """Columns of every table of a namespace, in schema order."""
    return schema_frame(load_tables(spark, namespace), namespace)
