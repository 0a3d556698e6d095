"""Sources, sinks, the Spark catalog and the metadata store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.operators import catalogue, classify, profile
from lakeveil.plans import jobs, seeds
from lakeveil.plans.schemas import SCHEMAS
from lakeveil.sources import catalog, ingest
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import new_folder, stored
from suite.base import (
    ALL,
    POLICIES_CTE,
    RULES_CTE,
    TABLES,
    classified_ctes,
    columns_cte,
    profiled,
    query,
    raw_namespace,
    samples_cte,
    table,
    tables,
)
from suite.generating import CITIZEN_SQL, HR_SQL, TX_SQL, fixture

# ------------------------------------------------------------ sources, sinks


def _own_namespace(spark: SparkSession, label: str) -> str:
    namespace = f"{label}_{uuid.uuid4().hex[:12]}"
    ingest.create_namespace(spark, namespace, new_folder(spark, namespace))
    return namespace


def _csv_copy(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """A folder with one ``<table>.csv`` per named table."""
    folder = new_folder(spark, "csv")
    for name in names:
        ingest.export_csv(table(spark, sf_dir, name), f"{folder}/{name}.csv")
    return folder


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def ingest_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _csv_copy(spark, sf_dir, ["customer"])
    return ingest.read_typed_csv(spark, f"{folder}/customer.csv", table(spark, sf_dir, "customer").schema)


@query("select 'customer' as table_name, 'LOADED' as status, count(*) as row_count from customer"
       " union all select 'supplier', 'LOADED', count(*) from supplier"
       " union all select 'part', 'LOADED', count(*) from part")
def ingest_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "supplier", "part"]
    schemas = {n: df.schema for n, df in tables(spark, sf_dir, names).items()}
    folder = _csv_copy(spark, sf_dir, names)
    return ingest.report(spark, ingest.ingest_all(spark, folder, schemas, _own_namespace(spark, "audit"))).drop("error")


@query("select c_custkey, true as stamped, true as same_for_all from customer")
def ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = ingest.stamp(table(spark, sf_dir, "customer"))
    stamps = stamped.agg(F.count_distinct(ingest.INGESTED_AT)).first()[0]
    return stamped.select(
        "c_custkey", F.col(ingest.INGESTED_AT).isNotNull().alias("stamped"), F.lit(stamps == 1).alias("same_for_all")
    )


@query("select event_id, epoch_us(ts) as ts_micros, user_id, event_type, value, props, true as stamped from events")
def ingest_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to a table, twice: the second load replaces the first."""
    folder, namespace = _csv_copy(spark, sf_dir, ["events"]), _own_namespace(spark, "written")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        ingest.ingest_table(spark, f"{folder}/events.csv", schema, f"{namespace}.events")
    return spark.table(f"{namespace}.events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"), "user_id", "event_type", "value",
        "props", F.col(ingest.INGESTED_AT).isNotNull().alias("stamped")
    )


@query("select 'citizen_info' as table_name, 'LOADED' as status, count(*) as row_count from customer"
       " union all select 'hr_employee', 'LOADED', count(*) from part"
       " union all select 'administrative_record', 'SKIPPED', null"
       " union all select 'transaction_log', 'LOADED', count(*) from events")
def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tables from CSV; one file is missing."""
    folder = new_folder(spark, "csv")
    for name in ("citizen_info", "hr_employee", "transaction_log"):
        ingest.export_csv(fixture(spark, sf_dir, name), f"{folder}/{name}.csv")
    results = ingest.ingest_all(spark, folder, SCHEMAS, _own_namespace(spark, "ingested"))
    return ingest.report(spark, results).drop("error")


@query("select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier")
def create_insert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inserts, matched by name, into a table that is created twice."""
    people = f"{_own_namespace(spark, 'people')}.people"
    for _ in range(2):
        ingest.create_table(spark, people, "id BIGINT, name STRING")
    ingest.insert_rows(table(spark, sf_dir, "customer").selectExpr("c_name as name", "c_custkey as id"), people)
    ingest.insert_rows(table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "s_name as name"), people)
    return spark.table(people)


def _damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The orders as CSV with cells that do not fit: every 7th price, every 11th customer, every 13th date."""
    folder = new_folder(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    damaged = orders.selectExpr(
        "o_orderkey",
        "if(o_orderkey % 11 = 0, concat('C', o_custkey), cast(o_custkey as string)) as o_custkey",
        "o_orderstatus",
        "if(o_orderkey % 7 = 0, 'n/a', cast(o_totalprice as string)) as o_totalprice",
        "if(o_orderkey % 13 = 0, 'soon', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")) as o_orderdate",
        "o_orderpriority",
    )
    ingest.export_csv(damaged, f"{folder}/orders.csv")
    return folder


def _audited(spark: SparkSession, sf_dir: str) -> tuple[str, list[ingest.IngestResult]]:
    namespace, schema = _own_namespace(spark, "audited"), table(spark, sf_dir, "orders").schema
    folder = _damaged_csv(spark, sf_dir)
    return namespace, ingest.ingest_all(spark, folder, {"orders": schema}, namespace, audited=True)


_LOST = {"o_custkey": "o_orderkey % 11 = 0", "o_totalprice": "o_orderkey % 7 = 0", "o_orderdate": "o_orderkey % 13 = 0"}


@query(" union all ".join(
    f"select 'orders' as table_name, '{c}' as column_name, count(*) filter ({_LOST.get(c, 'false')}) as cells_lost,"
    " count(*) as row_count from orders" for c in TABLES["orders"]))
def ingest_cell_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells lost per column, counted while a damaged file is loaded."""
    _, results = _audited(spark, sf_dir)
    return ingest.lost_cells(spark, results).withColumn("row_count", F.lit(results[0].row_count))


_LOST_LIST = ", ".join(f"case when {_LOST[c]} then '{c}' end" for c in TABLES["orders"] if c in _LOST)


@query(f"select o_orderkey, concat_ws(',', {_LOST_LIST}) as columns from orders where {' or '.join(_LOST.values())}")
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table: which cells of which lines did not fit."""
    namespace, _ = _audited(spark, sf_dir)
    return spark.table(f"{namespace}.orders__rejects").select(
        F.split("line", ",")[0].cast("bigint").alias("o_orderkey"), F.array_join("columns", ",").alias("columns")
    )


@query("select 'old' as seen, count(*) as row_count, sum(c_custkey)::bigint as keys from customer where c_custkey % 2 = 0"
       " union all select 'new', count(*), sum(c_custkey)::bigint from customer")
def ingest_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that was under way before a reload still finds the old rows; one that comes after it the new ones."""
    loaded, customers = f"{_own_namespace(spark, 'reloaded')}.customer", table(spark, sf_dir, "customer")
    ingest.write_table(customers.where("c_custkey % 2 = 0"), loaded)
    early = spark.table(loaded)
    ingest.write_table(customers, loaded)
    sums = [F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("keys")]
    old, new = early.agg(*sums), spark.table(loaded).agg(*sums)
    return old.select(F.lit("old").alias("seen"), "*").unionAll(new.select(F.lit("new").alias("seen"), "*"))


@query(f"{TX_SQL} select * from transactions")
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated rows with quotes and commas in their texts survive the way through CSV."""
    path = new_folder(spark, "export") + "/transaction_log.csv"
    ingest.export_csv(fixture(spark, sf_dir, "transaction_log"), path)
    back = ingest.read_typed_csv(spark, path, SCHEMAS["transaction_log"])
    return back.withColumn("tx_timestamp", F.col("tx_timestamp").cast("string"))


@query(f"{CITIZEN_SQL} select * replace (birth_date::date::varchar as birth_date) from citizens")
def export_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "export") + "/citizen_info.parquet"
    ingest.export_parquet(fixture(spark, sf_dir, "citizen_info"), path)
    return spark.read.parquet(path).withColumn("birth_date", F.col("birth_date").cast("string"))


# ----------------------------------------------------------------- catalog

_COUNTS = " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in ALL)


def _row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    return profile.union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
         for t, df in frames.items()]
    )


@query(_COUNTS)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a namespace as the catalog lists them, each loaded and counted."""
    namespace = raw_namespace(spark, sf_dir)
    listed = catalog.list_tables(spark, namespace).select("table_name")
    return listed.join(_row_counts(catalog.load_tables(spark, namespace)), "table_name")


@query(f"select 14 as tables, sum(row_count)::bigint as row_count from ({_COUNTS})", "list_namespaces")
def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace found in the listing, with its tables and rows."""
    namespace = raw_namespace(spark, sf_dir)
    found = catalog.list_namespaces(spark).where(F.col("namespace") == namespace)
    counts = _row_counts(catalog.load_tables(spark, namespace)).withColumn("namespace", F.lit(namespace))
    return counts.join(found, "namespace", "left_semi").agg(
        F.count(F.lit(1)).cast("int").alias("tables"), F.sum("row_count").alias("row_count")
    )


@query("select * replace (l_shipdate::varchar as l_shipdate) from lineitem")
def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = catalog.load_table(spark, raw_namespace(spark, sf_dir), "lineitem")
    return loaded.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query(f"with {columns_cte(ALL)}, counts as ({_COUNTS}) select table_name, ordinal, column_name, data_type, row_count"
       " from cols join counts using (table_name)")
def schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = raw_namespace(spark, sf_dir)
    counts = _row_counts(catalog.load_tables(spark, namespace))
    found = catalog.schema_scan(spark, namespace).join(counts, "table_name")
    return found.select("table_name", "ordinal", "column_name", "data_type", "row_count")


@query("select n_regionkey, count(*) as nations from nation group by n_regionkey")
def create_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating a namespace twice is no error; a table in it answers queries."""
    namespace = _own_namespace(spark, "fresh")
    ingest.create_namespace(spark, namespace)
    ingest.write_table(table(spark, sf_dir, "nation"), f"{namespace}.nation")
    return spark.table(f"{namespace}.nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))


# ------------------------------------------------------------ metadata store

_HELD = ["customer", "supplier"]  # registered before; customer lacks its last column


@query(f"with counts as ({_COUNTS}) select md5('raw' || chr(31) || table_name) as table_id, 'raw' as namespace,"
       " table_name, row_count from counts where table_name not in ('customer', 'supplier')")
def register_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = tables(spark, sf_dir, ALL)
    discovered = _row_counts(frames).withColumn("namespace", F.lit("raw"))
    registered = profile.schema_frame({t: frames[t] for t in _HELD}, "raw").select("namespace", "table_name")
    fresh = catalogue.new_tables(discovered, registered)
    return fresh.join(discovered, ["namespace", "table_name"]).select(
        "table_id", "namespace", "table_name", "row_count"
    )


_REGISTERED = (
    f"with {columns_cte(ALL)}, {samples_cte(ALL)}, arrays as (select table_name, column_name,"
    " to_json(list(sample_value order by sample_rank))::varchar as sample_values from samples group by all)"
    " select md5('raw' || chr(31) || table_name || chr(31) || column_name) as column_id, table_name, column_name,"
    " data_type, sample_values from cols left join arrays using (table_name, column_name)"
)


@query(f"{_REGISTERED} where table_name <> 'supplier' and (table_name <> 'customer' or column_name = 'c_mktsegment')")
def register_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns that the catalogue lacks are sampled and added."""
    frames = tables(spark, sf_dir, ALL)
    discovered = profile.schema_frame(frames, "raw")
    registered = discovered.where("table_name = 'supplier' or (table_name = 'customer' and column_name <> 'c_mktsegment')")
    fresh = catalogue.new_columns(discovered, registered)
    pending = {t: df.columns for t, df in frames.items() if t not in _HELD} | {"customer": ["c_mktsegment"]}
    arrays = profile.samples_as_arrays(profile.sample_tables(frames, pending))
    return catalogue.attach_samples(fresh, arrays).select(
        "column_id", "table_name", "column_name", "data_type", F.to_json("sample_values").alias("sample_values")
    )


@query(_REGISTERED)
def attach_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, samples = profiled(spark, sf_dir, ALL)
    rows = catalogue.attach_samples(columns, profile.samples_as_arrays(samples))
    return rows.select(
        catalogue.name_id(*catalogue.COLUMN_KEY).alias("column_id"),
        "table_name",
        "column_name",
        "data_type",
        F.to_json("sample_values").alias("sample_values"),
    )


_CLASSIFIED = classified_ctes(ALL)


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(*profiled(spark, sf_dir, ALL), with_samples=True)


def _catalogued(results: DataFrame) -> DataFrame:
    """Catalogue rows before the scan: everything was held to be a salary."""
    return results.select(
        *catalogue.COLUMN_KEY,
        F.lit("SALARY").alias("pii_category"),
        F.lit("HIGH").alias("sensitivity"),
        F.lit("MANUAL").alias("detection_method"),
        F.lit(None).cast("decimal(5,4)").alias("confidence_score"),
        F.array().cast("array<string>").alias("sample_values"),
        F.lit(False).alias("scanned"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


_APPLIED = (
    f"with {_CLASSIFIED}, kept as (select table_name, column_name, count(*) as n_samples from samples"
    " where sample_rank <= 10 group by all), applied as (select table_name, column_name, category as pii_category,"
    " sensitivity, detection_method, round(confidence, 4)::double as confidence_score,"
    " coalesce(n_samples, 0) as n_samples, detection_method <> 'UNKNOWN' as scanned, true as touched"
    " from classified left join kept using (table_name, column_name))"
)


def _applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _results(spark, sf_dir)
    rows = catalogue.apply_classification(_catalogued(results), results)
    return rows.select(
        "table_name",
        "column_name",
        "pii_category",
        "sensitivity",
        "detection_method",
        F.col("confidence_score").cast("double").alias("confidence_score"),
        F.size("sample_values").cast("bigint").alias("n_samples"),
        "scanned",
        F.col("updated_at").isNotNull().alias("touched"),
    )


@query(f"{_APPLIED} select * from applied")
def apply_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir)


@query(f"{_APPLIED} select table_name, column_name, confidence_score from applied where not scanned and"
       " table_name = 'documents'")
def unscanned_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = catalogue.unscanned_columns(_applied(spark, sf_dir), "documents")
    return pending.select("table_name", "column_name", "confidence_score")


_SCANNED = ["nation", "customer", "documents"]


@query(f"with {classified_ctes(_SCANNED)}, runs as (select unnest([1, 2]) as run)"
       " select table_name, column_name, category as detected_category, detection_method,"
       " round(confidence, 4)::double as confidence_score, count(*) as records from classified, runs"
       " where run = 1 or detection_method = 'UNKNOWN' group by all")
def scan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue and two scans through the store; the second takes up the open columns again."""
    raw, namespace = raw_namespace(spark, sf_dir, _SCANNED), f"gov_{uuid.uuid4().hex[:12]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    jobs.catalogue_namespace(spark, store, raw)
    for _ in range(2):
        jobs.scan_namespace(spark, store, raw)
    names = store.read("columns_metadata").select("column_id", "table_name", "column_name")
    return (
        store.read("pii_scan_record")
        .join(names, "column_id")
        .groupBy("table_name", "column_name", "detected_category", "detection_method",
                 F.col("confidence_score").cast("double").alias("confidence_score"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(f"with {_CLASSIFIED} select table_name, column_name, category as detected_category, detection_method,"
       " round(confidence, 4)::double as confidence_score, case detection_method when 'UNKNOWN' then 3 else 1 end::bigint"
       " as scans from classified")
def scan_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record of every column after three scans that reuse samples, merged run by run; the history is compacted in between."""
    raw, namespace = raw_namespace(spark, sf_dir), f"gov_{uuid.uuid4().hex[:12]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    jobs.catalogue_namespace(spark, store, raw, reuse_samples=True)
    for _ in range(3):
        jobs.scan_namespace(spark, store, raw, reuse_samples=True)
        store.compact_history()
    names = store.read("columns_metadata").select("column_id", "table_name", "column_name")
    return store.read("pii_scan_state").join(names, "column_id").select(
        "table_name", "column_name", "detected_category", "detection_method",
        F.col("confidence_score").cast("double").alias("confidence_score"), "scans",
    )


@query("select 'first' as run, 14::bigint as tables, count(*) as columns, sum(row_count)::bigint as row_count from"
       f" (with {columns_cte(ALL)}, counts as ({_COUNTS}) select * from cols join counts using (table_name)) union all"
       f" select 'again', 14, count(*), sum(row_count)::bigint from (with {columns_cte(ALL)}, counts as ({_COUNTS})"
       " select * from cols join counts using (table_name))")
def guarded_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables and columns registered, and registered again from another session that read nothing of it."""
    namespace = f"gov_{uuid.uuid4().hex[:12]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    columns, counts = profile.schema_frame(tables(spark, sf_dir, ALL), "raw"), _row_counts(tables(spark, sf_dir, ALL))
    frames = []
    for run, session in (("first", spark), ("again", spark.newSession())):
        mine, now = MetadataStore(session, namespace), F.current_timestamp()
        found = session.createDataFrame(columns.toPandas())
        fresh = catalogue.new_columns(found, mine.read("columns_metadata").where("false"))
        times = [now.alias("created_at"), now.alias("updated_at")]
        held = {*fresh.columns, "created_at", "updated_at"}
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in mine.schema("columns_metadata") if f.name not in held]
        mine.append_new("columns_metadata", fresh.select("*", *missing, *times))
        mine.append_new("tables_metadata", fresh.select("table_id", "namespace", "table_name").distinct().select("*", *times))
        spark.catalog.refreshTable(f"{namespace}.columns_metadata")
        spark.catalog.refreshTable(f"{namespace}.tables_metadata")
        held = store.read("columns_metadata").join(counts, "table_name")
        listed = store.read("tables_metadata").agg(F.count(F.lit(1)).alias("tables"))
        sums = held.agg(F.count(F.lit(1)).alias("columns"), F.sum("row_count").alias("row_count"))
        # Stored, as the next run changes the tables.
        frames.append(stored(listed.join(sums).select(F.lit(run).alias("run"), "*"), "held"))
    return profile.union_all(frames)


@query(f"with {_CLASSIFIED} select count(distinct table_name) as tables_processed, count(*) as columns_scanned,"
       " count(category) as pii_detected, count(*) - count(category) as unsure, 0::bigint as clean from classified")
def scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.scan_summary(_results(spark, sf_dir), len(ALL))


@query(f"with {_CLASSIFIED} select table_name, column_name, confidence from classified"
       " where detection_method = 'UNKNOWN'")
def rescan_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.rescan_queue(_results(spark, sf_dir)).select("table_name", "column_name", "confidence")


@query(f"with {_CLASSIFIED} select table_name, column_name, category, rule_order::int as category_id, sensitivity,"
       " case sensitivity when 'HIGH' then 1 when 'MEDIUM' then 2 when 'LOW' then 3 when 'NONE' then 4 end::int"
       " as sensitivity_id from classified left join rules on code = category")
def code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.code_lookup(_results(spark, sf_dir), seeds.pii_categories(spark), "category")
    found = catalogue.code_lookup(found, seeds.sensitivity_levels(spark), "sensitivity")
    return found.select("table_name", "column_name", "category", "category_id", "sensitivity", "sensitivity_id")


@query(f"with {_CLASSIFIED} select table_name, column_name, category, confidence from classified"
       " where table_name = 'customer'")
def columns_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _results(spark, sf_dir)
    rows = catalogue.columns_by_table(results, results, "raw", "customer")
    return rows.select("table_name", "column_name", "category", "confidence")


@query(f"with {RULES_CTE} select rule_order::int as rule_order, code, level as sensitivity, len(aliases)::int as aliases,"
       " case when pattern is null then 0 else (select count(*) from documents where regexp_matches(text, pattern)) end"
       "::bigint as documents_hit from rules")
def load_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as loaded from the category table, with the documents each pattern is found in.

    The category table also holds a code nobody knows, which is dropped.
    """
    known = seeds.pii_categories(spark)
    categories = known.unionAll(known.where("id = 1").selectExpr(
        "99", "'SHOE_SIZE'", "regex_pattern", "column_name_aliases", "default_sensitivity"))
    rules = seeds.collect_rules(categories)
    counts = table(spark, sf_dir, "documents").agg(
        *[F.count_if(F.col("text").rlike(r.pattern)).alias(r.code) for r in rules if r.pattern]
    )
    pairs = ", ".join(f"struct('{r.code}' as code, {r.code} as hits)" for r in rules if r.pattern)
    hits = counts.selectExpr(f"inline(array({pairs}))")
    return seeds.load_rules(categories).join(hits, "code", "left").select(
        "rule_order", "code", "sensitivity", F.size("column_name_aliases").alias("aliases"),
        F.coalesce("hits", F.lit(0)).alias("documents_hit"),
    )


@query(f"with {_CLASSIFIED}, {POLICIES_CTE} select * from (values ('unique_table', 0::bigint), ('unique_column', 0),"
       " ('unique_policy', 1), ('column_has_table', (select count(*) from classified where table_name = 'documents')),"
       " ('record_has_column', (select count(*) from classified where table_name = 'part')),"
       " ('known_category', (select count(*) from classified where category is not null and table_name <> 'part')),"
       " ('known_level', 0)) v(\"constraint\", violations)")
def metadata_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on a catalogue with faults: documents has no table row, part has
    records but no columns, categories are misspelt and one policy is doubled."""
    results = _results(spark, sf_dir)
    columns = results.where("table_name <> 'part'").select(
        catalogue.name_id(*catalogue.TABLE_KEY).alias("table_id"),
        catalogue.name_id(*catalogue.COLUMN_KEY).alias("column_id"),
        *catalogue.COLUMN_KEY,
        F.lower("category").alias("pii_category"),
        "sensitivity",
    )
    discovered = results.where("table_name <> 'documents'")
    held = catalogue.new_tables(discovered, discovered.where("false"))
    policies = seeds.access_policies(spark)
    doubled = policies.unionAll(policies.where("role_name = 'ADMIN' and sensitivity = 'LOW'"))
    return catalogue.constraint_violations(held, columns, doubled, catalogue.scan_records(results))


@query("select 'customer' as table_name, 'LOADED' as status, count(*) as row_count from customer"
       " union all select 'torn', 'FAILED', null union all select 'supplier', 'LOADED', count(*) from supplier")
def table_failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of three tables holds no Parquet; the other two are catalogued all the same."""
    raw = _own_namespace(spark, "partly")
    names = ["customer", "supplier"]
    for name in names:
        spark.sql(f"CREATE TABLE {raw}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    torn = _csv_copy(spark, sf_dir, ["region"]) + "/region.csv"
    spark.sql(f"CREATE TABLE {raw}.torn (r_regionkey INT, r_name STRING) USING parquet LOCATION '{torn}'")
    namespace = f"gov_{uuid.uuid4().hex[:12]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    report = ingest.report(spark, jobs.catalogue_namespace(spark, store, raw))
    counts = _row_counts({n: catalog.load_table(spark, raw, n) for n in names})
    return report.select("table_name", "status").join(counts, "table_name", "left")


@query("select 'customer' as table_name, 'LOADED' as status, count(*) as row_count, 5::bigint as records from customer"
       " union all select 'supplier', 'LOADED', count(*), 4 from supplier"
       " union all select 'nation', 'LOADED', count(*), 3 from nation"
       " union all select 'dropped', 'FAILED', null, null union all select 'torn', 'FAILED', null, null")
def scan_failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After cataloguing, one table is dropped and one loses its data; the others are scanned, with their history."""
    raw, names = _own_namespace(spark, "scanned"), ["customer", "supplier", "nation"]
    for name in names:
        spark.sql(f"CREATE TABLE {raw}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    spark.sql(f"CREATE TABLE {raw}.dropped USING parquet LOCATION '{sf_dir}/region.parquet'")
    spark.sql(f"CREATE TABLE {raw}.torn USING parquet LOCATION '{sf_dir}/region.parquet'")
    namespace = f"gov_{uuid.uuid4().hex[:12]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    jobs.catalogue_namespace(spark, store, raw)
    spark.sql(f"DROP TABLE {raw}.dropped")
    broken = _csv_copy(spark, sf_dir, ["region"]) + "/region.csv"
    spark.sql(f"ALTER TABLE {raw}.torn SET LOCATION '{broken}'")
    _, results = jobs.scan_namespace(spark, store, raw)
    report = ingest.report(spark, results).select("table_name", "status")
    records = store.read("pii_scan_record").join(store.read("columns_metadata").select("column_id", "table_name"), "column_id")
    records = records.groupBy("table_name").agg(F.count(F.lit(1)).alias("records"))
    counts = _row_counts({n: catalog.load_table(spark, raw, n) for n in names})
    return report.join(counts, "table_name", "left").join(records, "table_name", "left")
