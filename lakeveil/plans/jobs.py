"""The end-to-end jobs: catalogue a namespace, scan it for personal data, read it governed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.sqltext import identifier
from lakeveil.operators import catalogue, classify, governed, policy, profile
from lakeveil.plans.seeds import collect_rules
from lakeveil.sources import catalog, versions
from lakeveil.sources.ingest import IngestResult, create_namespace, raise_on_failure
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import stored


def isolate_failures(work: Callable[[list[str]], None], tables: list[str]) -> list[IngestResult]:
    """Run ``work`` on all tables in one go; a batch that fails is halved, again and again, down to single tables.

    One job for all is much cheaper; ``work`` must leave nothing behind where it fails. One bad table of n costs
    some 2 log2 n jobs more. If the first half of a failed batch succeeds, the fault is taken to be in the second, which is halved at once.
    """
    results: dict[str, IngestResult] = {}

    def attempt(batch: list[str]) -> bool:
        try:
            work(batch)
        except Exception as error:  # the report carries it
            if len(batch) > 1:
                halve(batch)
            else:
                results[batch[0]] = IngestResult(batch[0], "FAILED", error=str(error))
            return False
        results.update({t: IngestResult(t, "LOADED") for t in batch})
        return True

    def halve(batch: list[str]) -> None:
        middle = len(batch) // 2
        first, second = batch[:middle], batch[middle:]
        if attempt(first) and len(second) > 1:
            halve(second)
        else:
            attempt(second)

    if tables:
        attempt(tables)
    return [results[t] for t in tables]


def _names_by_table(columns: DataFrame) -> dict[str, list[str]]:
    """Column names per table in schema order; one row per column of the catalogue."""
    rows = columns.select("table_name", "ordinal", "column_name").collect()
    names: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r.table_name, r.ordinal)):
        names.setdefault(row.table_name, []).append(row.column_name)
    return names


def catalogue_namespace(
    spark: SparkSession,
    store: MetadataStore,
    namespace: str,
    sample_size: int = profile.DEFAULT_SAMPLE_SIZE,
    reuse_samples: bool = False,
    strict: bool = False,
) -> list[IngestResult]:
    """Register new tables and columns with samples. Running it again adds nothing. With ``reuse_samples`` the samples
    are kept in the store, so that a scan that reuses them doesn't read the tables again. With ``strict``, failed
    tables raise an error after the others are registered."""

    def register(names: list[str]) -> None:
        tables = {t: catalog.load_table(spark, namespace, t) for t in names}
        discovered = profile.schema_frame(tables, namespace)
        columns = catalogue.new_columns(discovered, store.read("columns_metadata"))
        pending = _names_by_table(columns)
        now = F.current_timestamp()
        if pending:
            if reuse_samples:
                samples = refresh_samples(spark, store, namespace, pending, sample_size)
            else:
                samples = profile.sample_tables(tables, pending, sample_size)
            rows = catalogue.attach_samples(columns, profile.samples_as_arrays(samples))
            empty = {
                "pii_category": "string",
                "sensitivity": "string",
                "detection_method": "string",
                "confidence_score": "decimal(5,4)",
            }
            rows = rows.select("*", *[F.lit(None).cast(t).alias(n) for n, t in empty.items()])
            rows = rows.select("*", F.lit(False).alias("scanned"), now.alias("created_at"), now.alias("updated_at"))
            store.append_new("columns_metadata", rows)
        fresh = catalogue.new_tables(discovered, store.read("tables_metadata"))
        store.append_new("tables_metadata", fresh.select("*", now.alias("created_at"), now.alias("updated_at")))

    report = isolate_failures(register, catalog.table_names(spark, namespace))
    if strict:
        raise_on_failure(report)
    return report


def refresh_samples(
    spark: SparkSession,
    store: MetadataStore,
    namespace: str,
    columns: dict[str, list[str]],
    sample_size: int = profile.DEFAULT_SAMPLE_SIZE,
) -> DataFrame:
    """Samples of ``columns``, as ``profile.sample_tables`` gives them, from the store's samples and the files that came since.

    The store keeps the samples of every column and the files they cover. Files are taken not to change, as
    Spark and table formats write them. If one is gone, e.g. after a reload, the table is read anew; so is a
    column that was not sampled before, or for fewer values. Old files are not opened otherwise. The names of a table's
    files pass through the driver, as they do when Spark lists it.
    """
    frames = {t: catalog.load_table(spark, namespace, t) for t in columns}
    state = store.read("sample_state").where(F.col("namespace") == namespace)
    seen = store.read("sampled_files").where(F.col("namespace") == namespace)
    mine = F.col("table_name").isin(*columns)
    rows = seen.where(mine).select("table_name", "file_path", "column_names", "sample_size").collect()
    new_files, merged, anew = {}, {}, {}
    listed, covered, size = {}, {}, {}
    for table, df in frames.items():
        known = [r for r in rows if r.table_name == table]
        listed[table] = df.inputFiles()
        old = {r.file_path for r in known}
        usable = bool(known) and old <= set(listed[table]) and all(r.sample_size >= sample_size for r in known)
        held = [c for c in known[0].column_names if c in df.columns] if usable else []
        size[table] = max([sample_size, *[r.sample_size for r in known if usable]])
        covered[table] = sorted({*held, *columns[table]})
        fresh = [f for f in listed[table] if f not in old]
        missing = [c for c in columns[table] if c not in held]
        if held and fresh:
            merged[table], new_files[table] = held, fresh
        if missing:
            anew[table] = missing
    parts = []
    kept = state.where(mine).select("table_name", "column_name", "sample_rank", "sample_value")
    # A column that is read anew loses what was held of it.
    for table in frames:
        stays = [c for c in covered[table] if c not in anew.get(table, [])]
        kept = kept.where((F.col("table_name") != table) | F.col("column_name").isin(*stays))
    for k in sorted(set(size.values())):
        some = [t for t in frames if size[t] == k]
        before = kept.where(F.col("table_name").isin(*some))
        parts.append(
            profile.merge_samples(
                before,
                {t: _only_files(spark, namespace, t, frames[t], new_files[t]) for t in some if t in merged},
                {t: merged[t] for t in some if t in merged},
                k,
            )
        )
        if any(t in anew for t in some):
            parts.append(profile.sample_tables(frames, {t: anew[t] for t in some if t in anew}, k))
    samples = stored(profile.union_all(parts), "samples")
    name = F.lit(namespace).alias("namespace")
    others = state.where(~mine).select(name, "table_name", "column_name", "sample_rank", "sample_value")
    store.replace_namespace("sample_state", others.unionByName(samples.select(name, "*")), namespace)
    files = [(namespace, t, f, covered[t], size[t]) for t in frames for f in listed[t]]
    schema = "namespace string, table_name string, file_path string, column_names array<string>, sample_size int"
    held_files = seen.where(~mine).unionByName(spark.createDataFrame(files, schema))
    store.replace_namespace("sampled_files", held_files, namespace)
    wanted = [(t, c) for t, names in columns.items() for c in names]
    asked = spark.createDataFrame(wanted, "table_name string, column_name string")
    found = samples.where(F.col("sample_rank") <= sample_size).join(asked, ["table_name", "column_name"], "left_semi")
    return found.select("table_name", "column_name", "sample_rank", "sample_value")


def _only_files(spark: SparkSession, namespace: str, table: str, df: DataFrame, files: list[str]) -> DataFrame:
    """The rows of some files of a table, partition columns included."""
    root = versions.location(spark, f"{namespace}.{identifier(table)}")
    provider = versions.details(spark, f"{namespace}.{identifier(table)}")["Provider"]
    return spark.read.format(provider).schema(df.schema).option("basePath", root).load(files)


def scan_namespace(
    spark: SparkSession,
    store: MetadataStore,
    namespace: str,
    sample_size: int = profile.DEFAULT_SAMPLE_SIZE,
    strict: bool = False,
    reuse_samples: bool = False,
) -> tuple[DataFrame, list[IngestResult]]:
    """Classify every unscanned column of the tables the catalogue lists; (summary, per-table report).

    Only the detection is done in one go and, if that fails, table by table: a dropped or torn
    table costs itself alone. What was found is stored, then written with one append to
    the history and one update of the columns, in that order: a scan cut short between
    them is repeated, and no column counts as scanned without a history row. With
    ``strict``, failed tables raise an error after the others are written. With ``reuse_samples`` the
    store's samples are brought up to date from new files instead of reading whole tables.
    """
    rules = collect_rules(store.read("pii_categories"))
    tables = store.read("tables_metadata").where(F.col("namespace") == namespace).select("table_name").distinct()
    listed = {r.table_name for r in tables.collect()}  # one row per table
    pending = catalogue.unscanned_columns(store.read("columns_metadata").where(F.col("namespace") == namespace))
    names = {t: columns for t, columns in _names_by_table(pending).items() if t in listed}
    found: list[DataFrame] = []

    def detect(chosen: list[str]) -> None:
        frames = {t: catalog.load_table(spark, namespace, t) for t in chosen}
        wanted = {t: names[t] for t in chosen}
        if reuse_samples:
            samples = refresh_samples(spark, store, namespace, wanted, sample_size)
        else:
            samples = profile.sample_tables(frames, wanted, sample_size)
        columns = pending.where(F.col("table_name").isin(*chosen)).select(*catalogue.COLUMN_KEY)
        found.append(stored(classify.classify(columns, samples, rules, with_samples=True), "scan"))

    report = isolate_failures(detect, list(names)) if names else []
    results = profile.union_all(found) if found else _no_results(spark)
    if found:
        store.record_scan(catalogue.scan_records(results), namespace)
        columns = store.read("columns_metadata").where(F.col("namespace") == namespace)
        store.replace_namespace("columns_metadata", catalogue.apply_classification(columns, results), namespace)
    if strict:
        raise_on_failure(report)
    return catalogue.scan_summary(results, len(listed)), report


def _no_results(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "select '' as namespace, '' as table_name, cast(null as string) as category, '' as detection_method where false"
    )


def _actions_by_table(
    store: MetadataStore, namespace: str, role: str, table: str | None = None
) -> dict[str, dict[str, governed.ColumnAction]]:
    """The plan of ``role`` for the registered tables of a namespace, or one of them, from one read of the catalogue.

    A registered table without catalogued columns is an error: all of its columns would pass as unknown.
    """
    policies = policy.policies_for_role(store.read("access_policies"), store.read("roles"), role)
    listed = store.read("tables_metadata").where(F.col("namespace") == namespace)
    columns = store.read("columns_metadata").where(F.col("namespace") == namespace)
    if table is not None:
        columns = catalogue.columns_by_table(columns, listed, namespace, table)
        listed = listed.where(F.col("table_name") == table)
    plan = policy.access_plan(columns.withColumnRenamed("pii_category", "category"), policies, [role])
    # One row per column, or per table without columns.
    rows = listed.select("table_name").distinct().join(
        plan.select("table_name", "column_name", "action", "masking_function", "category"), "table_name", "left"
    )
    found: dict[str, dict[str, governed.ColumnAction]] = {}
    for row in rows.collect():
        if row.column_name is None:
            raise ValueError(f"{namespace}.{row.table_name} is registered without columns: catalogue it again")
        found.setdefault(row.table_name, {})[row.column_name] = governed.ColumnAction(*row[1:])
    return found


def governed_table(
    spark: SparkSession,
    store: MetadataStore,
    namespace: str,
    table: str,
    role: str,
    columns: list[str] | None = None,
    unknown: str = "allow",
) -> DataFrame:
    """The table as ``role`` may see it. Unknown roles and tables are errors."""
    actions = _actions_by_table(store, namespace, role, table)[table]
    return governed.govern(catalog.load_table(spark, namespace, table), actions, columns, unknown)


def publish_views(
    spark: SparkSession, store: MetadataStore, namespace: str, role: str, views: str, unknown: str = "allow"
) -> list[IngestResult]:
    """Permanent views of the registered tables in the namespace ``views``, as ``role`` may see them, for users of SQL.

    A view's text is the projection that ``governed_table`` applies, so filters and pruning reach the scan as they
    do there. Running it again rebuilds the views whose plan or table has changed and drops those whose table is
    gone or hidden whole. A column that a table gets later is not in its view until then.
    Statuses: LOADED (made or rebuilt), UNCHANGED, DROPPED.
    """
    create_namespace(spark, views)
    actions = _actions_by_table(store, namespace, role)
    existing, present = set(catalog.table_names(spark, views)), set(catalog.table_names(spark, namespace))
    results = []
    for table in sorted(actions.keys() | existing):
        view = f"{views}.{identifier(table)}"
        shown = []
        if table in actions and table in present:
            shown = governed.visible(catalog.load_table(spark, namespace, table).columns, actions[table], unknown=unknown)
        if not shown:
            if table in existing:
                spark.sql(f"DROP VIEW {view}")
                results.append(IngestResult(table, "DROPPED"))
            continue
        body = f"SELECT {', '.join(governed.action_sql(a) for a in shown)} FROM {namespace}.{identifier(table)}"
        mark = hashlib.md5(body.encode()).hexdigest()
        if table in existing and _view_mark(spark, view) == mark:
            results.append(IngestResult(table, "UNCHANGED"))
            continue
        spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_MARK}' = '{mark}') AS {body}")
        results.append(IngestResult(table, "LOADED"))
    return results


_MARK = "lakeveil.plan"


def _view_mark(spark: SparkSession, view: str) -> str | None:
    """Which plan a view was made from."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").where(F.col("key") == _MARK).collect()
    return rows[0].value if rows else None
