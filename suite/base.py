"""Shared pieces of the registered queries: tables, registration, SQL building blocks.

The SQL below is written for DuckDB and does not use the library, so that the
two sides of a comparison share nothing but the input tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeveil.operators import profile
from lakeveil.plans import jobs
from lakeveil.sources.ingest import create_namespace, raise_on_failure
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Columns and Spark types of the driver's tables.
TABLES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}
ALL = list(TABLES)


def query(oracle: str | None = None, name: str | None = None):
    """Register a query under its (function's) name, with the SQL it must agree with."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


def raw_namespace(spark: SparkSession, sf_dir: str, names: list[str] = ALL) -> str:
    """A namespace whose tables are the Parquet files themselves; no data is copied."""
    tag = hashlib.md5(f"{sf_dir}|{','.join(names)}".encode()).hexdigest()[:8]
    namespace = f"raw_{tag}"
    if not spark.catalog.databaseExists(namespace):
        create_namespace(spark, namespace, new_folder(spark, namespace))
    for name in names:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    return namespace


# The tables that the governed reads go to.
GOVERNED = ["customer", "supplier", "part", "orders"]


def governed_store(spark: SparkSession, sf_dir: str) -> tuple[MetadataStore, str]:
    """(store, namespace): these tables catalogued and scanned once a session; reads take their plan from the store."""
    raw = raw_namespace(spark, sf_dir, GOVERNED)
    store = MetadataStore(spark, f"gov_{raw}")
    if not spark.catalog.databaseExists(store.namespace):
        fresh = MetadataStore(spark, f"gov_{raw}").open(new_folder(spark, store.namespace))
        raise_on_failure(jobs.catalogue_namespace(spark, fresh, raw, reuse_samples=True))
        jobs.scan_namespace(spark, fresh, raw, strict=True, reuse_samples=True)
    return store, raw


_PROFILES: dict[tuple[str, ...], tuple[DataFrame, DataFrame]] = {}


def profiled(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(columns, samples) of the named tables. The samples are a stored table, made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, *names)
    if key not in _PROFILES:
        frames = tables(spark, sf_dir, names)
        _PROFILES[key] = profile.schema_frame(frames, "raw"), profile.sample_tables(frames)
    return _PROFILES[key]


# ---------------------------------------------------------------- DuckDB text


def text_sql(column: str, data_type: str) -> str:
    text = f"cast({column} as varchar)"
    if data_type == "array<float>":
        return f"cast(list_transform({column}, lambda x: cast(x as double)) as varchar)"
    if data_type == "timestamp_ntz":
        return f"case when contains({text}, '.') then rpad({text}, 26, '0') else {text} end"
    return text


def columns_cte(names: list[str]) -> str:
    """cols(namespace, table_name, ordinal, column_name, data_type)"""
    rows = ", ".join(
        f"('raw', '{t}', {i}, '{c}', '{k}')" for t in names for i, (c, k) in enumerate(TABLES[t].items())
    )
    return f"cols(namespace, table_name, ordinal, column_name, data_type) as (values {rows})"


def samples_cte(names: list[str], k: int = 50, only: dict[str, list[str]] | None = None) -> str:
    """samples(table_name, column_name, sample_value, sample_rank)"""
    parts = [
        f"select distinct '{t}' as table_name, '{c}' as column_name, {text_sql(c, kind)} as sample_value"
        f" from {t} where {c} is not null"
        for t in names
        for c, kind in TABLES[t].items()
        if only is None or c in only[t]
    ]
    return (
        "samples as (select * from (select *, row_number() over (partition by table_name, column_name"
        " order by md5(sample_value), sample_value) as sample_rank"
        f" from ({' union all '.join(parts)})) where sample_rank <= {k})"
    )


# The rules and policies, as plain SQL.
RULES_CTE = """rules(rule_order, code, pattern, aliases, level) as (values
(1, 'NATIONAL_ID', '[0-9]{12}',
 ['cccd','cmnd','citizenid','nationalid','identitynumber','personalid'], 'HIGH'),
(2, 'BANK_ACCOUNT', '[0-9]{8,20}', ['bankaccount','accountnumber','bankacc','stk','sotaikhoan'], 'HIGH'),
(3, 'TAX_CODE', '[0-9]{10}(-[0-9]{3})?', ['taxcode','taxid','mst','masothue'], 'HIGH'),
(4, 'SALARY', null, ['salary','wage','income','monthlysalary','annualsalary','luong','mucluong'], 'HIGH'),
(5, 'PHONE', '(03|05|07|08|09)[0-9]{8}',
 ['phone','phonenumber','mobile','mobilephone','telephone','tel','contactnumber','sdt','sodienthoai'], 'MEDIUM'),
(6, 'EMAIL', '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', ['email','emailaddress','mail'], 'MEDIUM'),
(7, 'FULL_NAME', null,
 ['fullname','name','customername','employeename','citizenname','personname','hoten','hovaten'], 'MEDIUM'),
(8, 'ADDRESS', null, ['address','homeaddress','residentialaddress','location','diachi'], 'LOW'),
(9, 'DATE_OF_BIRTH', null, ['dob','birthdate','birthday','dateofbirth','ngaysinh'], 'LOW'),
(10, 'WORKPLACE', null,
 ['workplace','company','companyname','organization','organizationname','employer','office','worklocation'], 'LOW'))"""

POLICIES_CTE = """policies(role_name, sensitivity, action, masking_function) as (values
('ADMIN','HIGH','ALLOW',null), ('ADMIN','MEDIUM','ALLOW',null), ('ADMIN','LOW','ALLOW',null),
('ADMIN','NONE','ALLOW',null),
('ANALYST','HIGH','MASK','HASH_MASK'), ('ANALYST','MEDIUM','MASK','PARTIAL_MASK'), ('ANALYST','LOW','ALLOW',null),
('ANALYST','NONE','ALLOW',null),
('AUDITOR','HIGH','MASK','REDACT'), ('AUDITOR','MEDIUM','MASK','REDACT'), ('AUDITOR','LOW','ALLOW',null),
('AUDITOR','NONE','ALLOW',null))"""

NORMALIZED = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"


def name_hits_cte(source: str = "cols", keys: str = "table_name, column_name") -> str:
    """name_hits(keys, name_category, name_confidence, name_sensitivity)"""
    return f"""name_hits as (select {keys}, code as name_category,
  case when list_contains(aliases, n) then 1.0::double else 0.7::double end as name_confidence,
  level as name_sensitivity
from (select distinct {keys}, {NORMALIZED.format('column_name')} as n from {source}) join rules
  on len(list_filter(aliases, lambda a: contains(n, a))) > 0
qualify row_number() over (partition by {keys} order by rule_order) = 1)"""


def regex_hits_cte(source: str = "samples", keys: str = "table_name, column_name", value: str = "sample_value") -> str:
    """ratios per rule, then regex_hits(keys, regex_category, regex_confidence, regex_sensitivity)"""
    return f"""ratios as (select {keys}, rule_order, code, level,
  avg(case when regexp_matches({value}, pattern) then 1.0::double else 0.0::double end) as ratio
from {source} cross join rules where pattern is not null and {value} is not null group by all),
regex_hits as (select {keys}, code as regex_category, ratio as regex_confidence, level as regex_sensitivity
from ratios where ratio > 0
qualify row_number() over (partition by {keys} order by ratio desc, rule_order) = 1)"""


COMBINED_CTE = """combined as (select namespace, table_name, column_name,
  coalesce(regex_category, name_category) as category,
  case when regex_category is null then coalesce(name_confidence, 0.0::double)
       when regex_category = name_category then 0.8::double * regex_confidence + 0.2::double * name_confidence
       else regex_confidence end as confidence,
  case when regex_category is null and name_category is null then 'UNKNOWN' when regex_category is null then 'MANUAL'
       when regex_category = name_category then 'HYBRID' else 'REGEX' end as detection_method,
  case when regex_category is null then name_sensitivity else regex_sensitivity end as sensitivity
from cols left join name_hits using (table_name, column_name) left join regex_hits using (table_name, column_name))"""

CLASSIFIED_CTE = """classified as (select namespace, table_name, column_name,
  case when confidence >= 0.7::double then category end as category, confidence,
  case when confidence >= 0.7::double then detection_method else 'UNKNOWN' end as detection_method,
  case when confidence >= 0.7::double then sensitivity end as sensitivity
from combined)"""


def classified_ctes(names: list[str]) -> str:
    """Everything up to ``classified``, to be put after WITH."""
    return ", ".join(
        [columns_cte(names), samples_cte(names), RULES_CTE, name_hits_cte(), regex_hits_cte(), COMBINED_CTE,
         CLASSIFIED_CTE]
    )


# DuckDB masks
def partial_sql(v: str) -> str:
    return f"substr({v}, 1, 1) || regexp_replace(substr({v}, 2), '.', '*', 'g')"


def keep_ends_sql(v: str, head: int, tail: int) -> str:
    kept = f"substr({v}, 1, {head}) || repeat('*', length({v}) - {head + tail}) || right({v}, {tail})"
    return f"case when length({v}) > {head + tail} then {kept} else {partial_sql(v)} end"


def email_sql(v: str) -> str:
    kept = f"substr(split_part({v}, '@', 1), 1, 1) || '***@' || split_part({v}, '@', -1)"
    # The address pattern is a fixed value, as in the rules.
    one = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
    return f"case when regexp_full_match({v}, '{one}') then {kept} else {partial_sql(v)} end"
