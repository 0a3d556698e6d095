"""The governance catalogue as DataFrame operators: what is new, what changed, what is wrong.

Tables and columns have string ids derived from their names, so any executor
can compute an id without coordination and a re-run gives the same one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeveil.operators.profile import stored_samples, union_all
from lakeveil.plans.seeds import CATEGORY_CODES, SENSITIVITY_LEVELS

_SEPARATOR = "\u001f"

TABLE_KEY = ["namespace", "table_name"]
COLUMN_KEY = ["namespace", "table_name", "column_name"]


def name_id(*parts: str):
    return F.md5(F.concat_ws(_SEPARATOR, *parts))


def new_tables(discovered: DataFrame, registered: DataFrame) -> DataFrame:
    """(table_id, namespace, table_name) not registered yet."""
    return (
        discovered.select(*TABLE_KEY)
        .distinct()
        .join(registered, TABLE_KEY, "left_anti")
        .select(name_id(*TABLE_KEY).alias("table_id"), *TABLE_KEY)
    )


def new_columns(discovered: DataFrame, registered: DataFrame) -> DataFrame:
    """Columns of ``discovered`` not registered yet, with their ids.

    Columns that were dropped or retyped since stay as registered.
    """
    return (
        discovered.join(registered, COLUMN_KEY, "left_anti")
        .withColumn("table_id", name_id(*TABLE_KEY))
        .withColumn("column_id", name_id(*COLUMN_KEY))
    )


def attach_samples(columns: DataFrame, sample_arrays: DataFrame) -> DataFrame:
    """``columns`` with ``sample_values``; NULL for a column without values."""
    return columns.join(sample_arrays, ["table_name", "column_name"], "left")


def unscanned_columns(columns: DataFrame, table: str | None = None) -> DataFrame:
    pending = columns.where(~F.col("scanned"))
    return pending if table is None else pending.where(F.col("table_name") == table)


def apply_classification(columns: DataFrame, results: DataFrame) -> DataFrame:
    """``columns`` after a scan: every scanned column takes its new result as it is.

    An UNKNOWN result clears an older category and leaves the column unscanned. A result
    for a column that isn't registered is an error.
    """
    strangers = results.join(columns, COLUMN_KEY, "left_anti").select(*COLUMN_KEY).take(1)
    if strangers:
        raise ValueError(f"no such column in the catalogue: {'.'.join(strangers[0])}")
    fresh = results.select(
        *COLUMN_KEY,
        F.col("category").alias("new_category"),
        F.col("sensitivity").alias("new_sensitivity"),
        F.col("detection_method").alias("new_method"),
        F.bround("confidence", 4).cast("decimal(5,4)").alias("new_confidence"),
        stored_samples(F.col("sample_values")).alias("new_samples"),
    )
    updated = {
        "pii_category": F.col("new_category"),
        "sensitivity": F.col("new_sensitivity"),
        "detection_method": F.col("new_method"),
        "confidence_score": F.col("new_confidence"),
        "sample_values": F.coalesce("new_samples", F.array().cast("array<string>")),
        "scanned": F.col("new_method") != "UNKNOWN",
        "updated_at": F.current_timestamp(),
    }
    hit = F.col("new_method").isNotNull()
    return columns.join(fresh, COLUMN_KEY, "left").select(
        *[F.when(hit, updated[c]).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in columns.columns]
    )


def scan_records(results: DataFrame) -> DataFrame:
    """One history row per scanned column, for UNKNOWN results too."""
    return results.select(
        name_id(*COLUMN_KEY).alias("column_id"),
        F.current_timestamp().alias("scan_timestamp"),
        "detection_method",
        F.bround("confidence", 4).cast("decimal(5,4)").alias("confidence_score"),
        F.col("category").alias("detected_category"),
    )


def scan_summary(results: DataFrame, listed: int | None = None) -> DataFrame:
    """(tables_processed, columns_scanned, pii_detected, unsure, clean)

    ``listed`` is the number of tables the scan went through, those without open
    columns among them; without it the tables with results are counted.
    """
    pii = F.count_if(F.col("category").isNotNull())
    unsure = F.count_if(F.col("category").isNull() & (F.col("detection_method") == "UNKNOWN"))
    return results.agg(
        (F.count_distinct(*TABLE_KEY) if listed is None else F.lit(listed).cast("long")).alias("tables_processed"),
        F.count(F.lit(1)).alias("columns_scanned"),
        pii.alias("pii_detected"),
        unsure.alias("unsure"),
        (F.count(F.lit(1)) - pii - unsure).alias("clean"),
    )


def rescan_queue(results: DataFrame) -> DataFrame:
    """Columns whose category is still open; every later scan takes them up again."""
    return results.where(F.col("detection_method") == "UNKNOWN")


def code_lookup(frame: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """``frame`` with ``<column>_id``, the id of the code in ``column``."""
    ids = codes.select(F.col(code).alias(column), F.col("id").alias(f"{column}_id"))
    return frame.join(ids, column, "left")


def policies_with_ids(policies: DataFrame, roles: DataFrame, masking_functions: DataFrame) -> DataFrame:
    """``policies`` with role_name_id and masking_function_id, NULL for a code that isn't known."""
    found = code_lookup(policies, roles, "role_name", "role_name")
    return code_lookup(found, masking_functions, "masking_function", "function_name")


def columns_by_table(columns: DataFrame, tables: DataFrame, namespace: str, table: str) -> DataFrame:
    """The catalogued columns of one table; an unregistered table is an error."""
    wanted = (F.col("namespace") == namespace) & (F.col("table_name") == table)
    if tables.where(wanted).isEmpty():
        raise ValueError(f"nothing catalogued under {namespace}.{table}")
    return columns.where(wanted)


def columns_by_table_id(columns: DataFrame, table_id: str) -> DataFrame:
    return columns.where(F.col("table_id") == table_id)


def _duplicates(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    repeated = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def _missing(frame: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    orphans = frame.dropna(subset=keys).join(parent.select(*keys).distinct(), keys, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def _outside(frame: DataFrame, column: str, allowed: list[str], name: str) -> DataFrame:
    bad = F.count_if(~F.col(column).isin(*allowed))
    return frame.agg(bad.alias("violations")).select(F.lit(name).alias("constraint"), "violations")


def constraint_violations(tables: DataFrame, columns: DataFrame, policies: DataFrame, records: DataFrame) -> DataFrame:
    """(constraint, violations): uniqueness, references and codes of the catalogue."""
    return union_all(
        [
            _duplicates(tables, TABLE_KEY, "unique_table"),
            _duplicates(columns, COLUMN_KEY, "unique_column"),
            _duplicates(policies, ["role_name", "sensitivity"], "unique_policy"),
            _missing(columns, tables, ["table_id"], "column_has_table"),
            _missing(records, columns, ["column_id"], "record_has_column"),
            _outside(columns, "pii_category", CATEGORY_CODES, "known_category"),
            _outside(columns, "sensitivity", SENSITIVITY_LEVELS, "known_level"),
        ]
    )
