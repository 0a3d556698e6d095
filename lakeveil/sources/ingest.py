"""Typed CSV ingest into managed tables, with an audit of rows and of cells that did not fit.

The counts ride along with the write (``observe``), so each file is read once; only if some rows had
bad cells, and they are wanted, it is read again for those rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeveil.functions.sqltext import identifier
from lakeveil.sources import versions

INGESTED_AT = "_ingested_at"
# The line of a row that has a bad cell, as it stands in the file.
BAD_LINE = "_bad_line"


@dataclass(frozen=True)
class IngestResult:
    table_name: str
    status: str  # LOADED, SKIPPED (no such file) or FAILED
    row_count: int | None = None
    error: str | None = None
    cells_lost: dict[str, int] | None = None  # per column; None if no audit was asked for


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header, read under ``schema``; a cell that does not fit becomes NULL.

    Doubled quotes are decoded. Quoted line breaks need ``multi_line``, which
    keeps Spark from splitting a file.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def stamp(df: DataFrame) -> DataFrame:
    """Add the ingest time, the same for every row of one load."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def read_audited_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """``read_typed_csv`` with ``BAD_LINE`` and, per column, whether its cell was lost (``_lost_<place>``).

    A cell is lost if it is NULL and the file has a text there. Only the lines of bad rows are parsed a second
    time, as texts, in the same pass. A row with too few or too many cells has a ``BAD_LINE`` too.
    """
    marked = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.schema(marked).option("header", True).option("encoding", "UTF-8").option("escape", '"')
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    df = reader.option("multiLine", multi_line).csv(path)
    texts = ", ".join(f"c{i} string" for i in range(len(schema.fields)))
    raw = F.from_csv(F.col(BAD_LINE), texts, {"escape": '"', "mode": "PERMISSIVE", "multiLine": str(multi_line)})
    df = df.withColumn("_raw", F.when(F.col(BAD_LINE).isNotNull(), raw))
    lost = [
        (F.col(identifier(f.name)).isNull() & F.col(f"_raw.c{i}").isNotNull()).alias(f"_lost_{i}")
        for i, f in enumerate(schema.fields)
    ]
    return df.select(*[F.col(identifier(f.name)) for f in schema.fields], BAD_LINE, *lost)


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """(columns array<string>, line): the bad rows, with the names of the columns whose cells were lost."""
    df = read_audited_csv(spark, path, schema, multi_line).where(F.col(BAD_LINE).isNotNull())
    names = F.array(*[F.when(F.col(f"_lost_{i}"), F.lit(f.name)) for i, f in enumerate(schema.fields)])
    return df.select(F.array_compact(names).alias("columns"), F.col(BAD_LINE).alias("line"))


def create_table(
    spark: SparkSession, table: str, schema: T.StructType | str, table_format: str = "parquet"
) -> None:
    """An empty table with these columns, unless there is one of that name; its namespace is created too."""
    if isinstance(schema, T.StructType):
        schema = ", ".join(f"{identifier(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    create_namespace(spark, table.rpartition(".")[0] or "default")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING {table_format}")


def insert_rows(df: DataFrame, table: str) -> None:
    """Append ``df``, whose columns are matched by name; one that the table lacks, or that is missing, is an error."""
    names = df.sparkSession.table(table).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"{table} has the columns {', '.join(names)}, the rows have {', '.join(df.columns)}")
    df.select(*[F.col(identifier(n)) for n in names]).write.insertInto(table)


def _plain(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def write_table(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Create or replace ``table``. Iceberg replaces atomically; so does the built-in catalog for the same columns, or
    those and more after them, by a new version folder (``versions``). It has no REPLACE for other columns: there the
    rows are written under another name first, so a failing load leaves the old table as it was, and then the
    names change hands, with a moment without the table."""
    if table_format == "iceberg":
        df.writeTo(table).using("iceberg").tableProperty("format-version", "2").createOrReplace()
        return
    spark = df.sparkSession
    finish_swap(spark, table)
    if not spark.catalog.tableExists(table):
        versions.clear_superseded(spark, table)
        df.write.format(table_format).saveAsTable(table)
        return
    old, new = _plain(spark.table(table).schema), _plain(df.schema)
    same_format = versions.details(spark, table).get("Provider") == table_format
    if same_format and new[: len(old)] == old:
        if new != old:
            added = ", ".join(f"{identifier(n)} {t}" for n, t in new[len(old) :])
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        versions.replace_table(df, table, table_format)
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")
    df.write.format(table_format).saveAsTable(f"{table}__next")
    versions.drop_table(spark, table)
    finish_swap(spark, table)


def finish_swap(spark: SparkSession, table: str) -> None:
    """Give the next version its name, if the old one is gone."""
    exists = spark.catalog.tableExists
    if exists(f"{table}__next") and not exists(table):
        spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")


def ingest_table(
    spark: SparkSession,
    csv_path: str,
    schema: T.StructType,
    table: str,
    table_format: str = "parquet",
    multi_line: bool = False,
    rejects: str | None = None,
) -> IngestResult:
    """Load one CSV file or folder into ``table``.

    With ``rejects``, the cells that were lost are counted per column in the same pass, and if there are bad rows
    they replace those of the table of that name: (columns, line). They stay in ``table`` as well, with NULLs.
    """
    name = table.split(".")[-1]
    read = read_typed_csv if rejects is None else read_audited_csv
    try:
        df = read(spark, csv_path, schema, multi_line)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return IngestResult(name, "SKIPPED")
        raise
    audit = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if rejects is None:
        write_table(stamp(df.observe(audit, *counts)), table, table_format)
        return IngestResult(name, "LOADED", audit.get["rows"])
    counts.append(F.count(BAD_LINE).alias("bad"))
    counts += [F.count_if(F.col(f"_lost_{i}")).alias(f"lost_{i}") for i in range(len(schema.fields))]
    kept = df.observe(audit, *counts).select(*[F.col(identifier(f.name)) for f in schema.fields])
    write_table(stamp(kept), table, table_format)
    found = audit.get
    if found["bad"] or spark.catalog.tableExists(rejects):
        write_table(rejected_rows(spark, csv_path, schema, multi_line), rejects, table_format)
    lost = {f.name: found[f"lost_{i}"] for i, f in enumerate(schema.fields)}
    return IngestResult(name, "LOADED", found["rows"], cells_lost=lost)


def lost_cells(spark: SparkSession, results: list[IngestResult]) -> DataFrame:
    """(table_name, column_name, cells_lost), one row per column of the audited tables."""
    rows = [(r.table_name, c, n) for r in results for c, n in (r.cells_lost or {}).items()]
    schema = pa.schema([("table_name", pa.string()), ("column_name", pa.string()), ("cells_lost", pa.int64())])
    return spark.createDataFrame(pa.table({n: [r[i] for r in rows] for i, n in enumerate(schema.names)}, schema=schema))


def ingest_all(
    spark: SparkSession,
    csv_dir: str,
    schemas: dict[str, T.StructType],
    namespace: str,
    table_format: str = "parquet",
    multi_line: bool = False,
    audited: bool = False,
) -> list[IngestResult]:
    """Load ``<csv_dir>/<table>.csv`` for every schema; one failure does not stop the others. With ``audited``, bad
    rows go to ``<table>__rejects``."""
    results = []
    for name, schema in schemas.items():
        try:
            path = f"{csv_dir}/{name}.csv"
            table = f"{namespace}.{name}"
            rejects = f"{table}__rejects" if audited else None
            results.append(ingest_table(spark, path, schema, table, table_format, multi_line, rejects))
        except Exception as error:  # the report carries it
            results.append(IngestResult(name, "FAILED", error=str(error)))
    return results


def report(spark: SparkSession, results: list[IngestResult]) -> DataFrame:
    """(table_name, status, row_count, error), one row per table."""
    schema = pa.schema(
        [
            ("table_name", pa.string()),
            ("status", pa.string()),
            ("row_count", pa.int64()),
            ("error", pa.string()),
        ]
    )
    columns = {n: [getattr(r, n) for r in results] for n in schema.names}
    return spark.createDataFrame(pa.table(columns, schema=schema))


def raise_on_failure(results: list[IngestResult]) -> None:
    failed = [f"{r.table_name}: {r.error}" for r in results if r.status == "FAILED"]
    if failed:
        raise RuntimeError("; ".join(failed))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header; quotes are doubled, times keep their microseconds. Empty
    texts are read back as NULL."""
    writer = df.write.mode("error").option("header", True).option("escape", '"')
    writer = writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("error").parquet(path)
