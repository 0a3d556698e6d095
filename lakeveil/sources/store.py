"""The metadata store: managed tables in one namespace of the Spark catalog.

Appends are plain inserts, guarded ones if a key is given. An update replaces the partition of one namespace by a new
version folder; ``open`` creates what is missing and finishes a swap of an earlier version that was cut short.
The history only grows; a state table beside it holds the latest record of every column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeveil.plans import seeds
from lakeveil.sources import versions
from lakeveil.sources.ingest import create_namespace, finish_swap
from lakeveil.sources.workspace import stored

_TABLES = {
    "tables_metadata": "table_id string, namespace string, table_name string, created_at timestamp,"
    " updated_at timestamp",
    "columns_metadata": "column_id string, table_id string, namespace string, table_name string, ordinal int,"
    " column_name string, data_type string, data_type_repr string, sample_values array<string>,"
    " pii_category string, sensitivity string, detection_method string, confidence_score decimal(5,4),"
    " scanned boolean, created_at timestamp, updated_at timestamp",
    "pii_scan_record": "column_id string, scan_timestamp timestamp, detection_method string,"
    " confidence_score decimal(5,4), detected_category string",
    "pii_scan_state": "namespace string, column_id string, scans bigint, scan_timestamp timestamp,"
    " detection_method string, confidence_score decimal(5,4), detected_category string",
    "sample_state": "namespace string, table_name string, column_name string, sample_rank int, sample_value string",
    "sampled_files": "namespace string, table_name string, file_path string, column_names array<string>,"
    " sample_size int",
}
KEYS = {"tables_metadata": ["table_id"], "columns_metadata": ["column_id"]}
_SEEDS = {
    "sensitivity_levels": seeds.sensitivity_levels,
    "roles": seeds.roles,
    "masking_functions": seeds.masking_functions,
    "pii_categories": seeds.pii_categories,
    "access_policies": seeds.access_policies,
}


class MetadataStore:
    """Reads and writes the governance tables of ``namespace``."""

    def __init__(self, spark: SparkSession, namespace: str, table_format: str = "parquet") -> None:
        self.spark = spark
        self.namespace = namespace
        self.table_format = table_format

    def _name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def open(self, location: str | None = None) -> "MetadataStore":
        """Create what is missing, seeds included."""
        create_namespace(self.spark, self.namespace, location)
        for table, columns in _TABLES.items():
            finish_swap(self.spark, self._name(table))
            parts = " PARTITIONED BY (namespace)" if "namespace string" in columns else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}) USING {self.table_format}{parts}"
            )
        for table, frame in _SEEDS.items():
            finish_swap(self.spark, self._name(table))
            if not self.spark.catalog.tableExists(self._name(table)):
                frame(self.spark).write.format(self.table_format).saveAsTable(self._name(table))
        return self

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def schema(self, table: str) -> T.StructType:
        return self.read(table).schema

    def append(self, table: str, rows: DataFrame) -> None:
        rows.select(*self.schema(table).names).write.insertInto(self._name(table))

    def append_new(self, table: str, rows: DataFrame) -> None:
        """Append the rows whose key (``KEYS``) the table lacks. A key that ``rows`` hold twice is an error.

        The table is compared and the keys are counted in the job that stores the rows, before anything is appended: a
        run that is repeated, in this session or another, adds nothing, and one with doubled keys fails whole.
        """
        key = KEYS[table]
        fresh = rows.select(*self.schema(table).names).join(self.read(table).select(*key), key, "left_anti")
        names = [n for n in fresh.columns if n not in key]
        grouped = fresh.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*names)).alias("row"))
        doubled = F.raise_error(F.concat(F.lit(f"{table} would get a key twice: "), F.concat_ws(".", *key)))
        checked = grouped.withColumn("row", F.when(F.col("n") == 1, F.col("row")).otherwise(doubled))
        self.append(table, stored(checked.select(*key, "row.*"), table))

    def replace_namespace(self, table: str, rows: DataFrame, namespace: str) -> None:
        """Put ``rows``, which may be derived from the table itself, in place of those of ``namespace``.

        Tables with a namespace are partitioned by it: other namespaces are not touched, so updates of different
        ones may run at once. The rows are written to a folder of their own, which becomes the partition's by one
        change of the catalogue: an update that fails leaves the old rows.
        """
        ordered = rows.where(F.col("namespace") == namespace).select(*self.schema(table).names)
        if self.table_format == "iceberg":
            ordered.writeTo(self._name(table)).overwritePartitions()
            return
        versions.replace_partition(ordered, self._name(table), "namespace", namespace, self.table_format)

    def record_scan(self, records: DataFrame, namespace: str) -> None:
        """Append to the history and merge the new records into the state: only the state, one row per column, and
        ``records`` are read, however long the history is."""
        records = stored(records, "records")
        self.append("pii_scan_record", records)
        before = self.read("pii_scan_state").where(F.col("namespace") == namespace)
        self.replace_namespace("pii_scan_state", merged_state(before, records, namespace), namespace)

    def rebuild_state(self, namespace: str) -> None:
        """The state from the whole history, for stores that had none."""
        ids = self.read("columns_metadata").where(F.col("namespace") == namespace).select("column_id")
        records = self.read("pii_scan_record").join(ids, "column_id", "left_semi")
        none = self.read("pii_scan_state").where("false")
        self.replace_namespace("pii_scan_state", merged_state(none, records, namespace), namespace)

    def compact_history(self, files: int = 8) -> None:
        """Rewrite the history as at most ``files`` files; readers find either all old ones or all new ones."""
        if self.table_format == "iceberg":
            self.spark.sql(f"CALL system.rewrite_data_files('{self._name('pii_scan_record')}')")
            return
        rows = self.read("pii_scan_record").repartition(files, "column_id")
        versions.replace_table(rows, self._name("pii_scan_record"), self.table_format)


_LATEST = ["scan_timestamp", "detection_method", "confidence_score", "detected_category"]


def merged_state(state: DataFrame, records: DataFrame, namespace: str) -> DataFrame:
    """(namespace, column_id, scans, the latest record): counts add up and the greatest time wins, so merging
    run by run gives what a full read of the history gives. Of equal times the larger record is kept."""
    new = records.select("column_id", F.lit(1).cast("long").alias("scans"), *_LATEST)
    both = state.select("column_id", "scans", *_LATEST).unionByName(new)
    latest = F.max(F.struct(*_LATEST)).alias("latest")
    merged = both.groupBy("column_id").agg(F.sum("scans").alias("scans"), latest)
    return merged.select(F.lit(namespace).alias("namespace"), "column_id", "scans", "latest.*")
