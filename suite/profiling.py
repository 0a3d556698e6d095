"""Sampling, detection and classification."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.names import alias_contains_sql, alias_exact_sql, normalize_name
from lakeveil.functions.text import as_text
from lakeveil.operators import classify, profile
from lakeveil.plans import seeds
from lakeveil.plans.jobs import refresh_samples
from lakeveil.sources.ingest import create_namespace, write_table
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import new_folder
from suite.base import (
    ALL,
    CLASSIFIED_CTE,
    COMBINED_CTE,
    NORMALIZED,
    RULES_CTE,
    TABLES,
    classified_ctes,
    columns_cte,
    name_hits_cte,
    profiled,
    query,
    regex_hits_cte,
    samples_cte,
    table,
    tables,
    text_sql,
)


@query(f"with {samples_cte(['lineitem'], only={'lineitem': ['l_extendedprice']})} "
       "select sample_rank::int as sample_rank, sample_value from samples")
def sample_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_column(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(f"with {samples_cte(ALL)} select table_name, column_name, sample_rank::int as sample_rank, sample_value"
       " from samples")
def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_tables(tables(spark, sf_dir, ALL))


@query(f"with {samples_cte(['orders'], only={'orders': ['o_orderdate', 'o_custkey']})} "
       "select column_name, sample_rank::int as sample_rank, sample_value from samples")
def column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = {"orders": table(spark, sf_dir, "orders")}
    return profile.sample_tables(orders, {"orders": ["o_orderdate", "o_custkey"]}).drop("table_name")


@query(f"with {samples_cte(['lineitem'])} select column_name, sample_rank::int as sample_rank, sample_value from samples")
def sample_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of a table that grew: of its first rows, then brought up to date from the files that came after."""
    lines = table(spark, sf_dir, "lineitem")
    raw, namespace = f"grown_{uuid.uuid4().hex[:12]}", f"gov_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, raw, new_folder(spark, raw))
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    write_table(lines.where("l_orderkey % 3 = 0"), f"{raw}.lineitem")
    refresh_samples(spark, store, raw, {"lineitem": lines.columns})
    lines.where("l_orderkey % 3 <> 0").write.insertInto(f"{raw}.lineitem")
    return refresh_samples(spark, store, raw, {"lineitem": lines.columns}).drop("table_name")


@query(f"select event_id, {text_sql('event_id', 'bigint')} as id_text, {text_sql('ts', 'timestamp_ntz')} as ts_text,"
       f" {text_sql('value', 'double')} as value_text,"
       f" {text_sql('value * 1e8', 'double')} as large_text, {text_sql('floor(value) * 1e17', 'double')} as huge_text"
       " from events")
def sample_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "value", "value * 1e8D as large", "floor(value) * 1e17D as huge"
    )
    types = {f.name: f.dataType for f in events.schema.fields}
    names = {"event_id": "id_text", "ts": "ts_text", "value": "value_text", "large": "large_text", "huge": "huge_text"}
    return events.select("event_id", *[as_text(n, types[n]).alias(alias) for n, alias in names.items()])


_MOMENT = (
    "'datetime.datetime(' || concat_ws(', ', year(o_orderdate), month(o_orderdate), day(o_orderdate), hour(o_orderdate),"
    " minute(o_orderdate)) || case when microsecond(o_orderdate) % 1000000 > 0 then ', ' || second(o_orderdate) || ', ' ||"
    " microsecond(o_orderdate) % 1000000 when second(o_orderdate) > 0 then ', ' || second(o_orderdate) else '' end || ')'"
)


@query(f"""select o_orderkey, 'Row(key=' || o_orderkey || ', placed=' || {_MOMENT} || ', price=' ||
  {text_sql('o_totalprice', 'double')} || ')' as row_text, '{{''' || o_orderpriority || ''': [' || o_custkey || ', None]}}' as map_text,
  'b"' || o_orderstatus || '''' || o_orderpriority || '\\xc3\\xa9"' as binary_text, '[Row(open=' ||
  case when o_orderstatus = 'O' then 'True' else 'False' end || ', note=None), None]' as list_text from orders""")
def sample_nested_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, dicts, bytes and lists made of the orders' columns, as Python prints them."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "named_struct('key', o_orderkey, 'placed', o_orderdate, 'price', o_totalprice) as row_text",
        "map(o_orderpriority, array(o_custkey, null)) as map_text",
        "encode(concat(o_orderstatus, char(39), o_orderpriority, char(233)), 'UTF-8') as binary_text",
        "array(named_struct('open', o_orderstatus = 'O', 'note', cast(null as string)), null) as list_text",
    )
    return orders.select("o_orderkey", *[as_text(f.name, f.dataType).alias(f.name) for f in orders.schema.fields[1:]])


@query(f"with {samples_cte(['part', 'customer'])} select table_name, column_name,"
       " to_json(list(sample_value order by sample_rank))::varchar as sample_values"
       " from samples where sample_rank <= 10 group by all")
def sample_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = profile.samples_as_arrays(profile.sample_tables(tables(spark, sf_dir, ["part", "customer"])))
    kept = profile.stored_samples(F.col("sample_values"))
    return arrays.select("table_name", "column_name", F.to_json(kept).alias("sample_values"))


# ------------------------------------------------------------------ names
# Every word of the documents is tried as a column name, next to the real ones.

_WORDS = (
    "words as (select distinct column_name from (select unnest(string_split(text, ' ')) as column_name from documents"
    " union all select column_name from cols))"
)
_WORD_CTES = f"{columns_cte(ALL)}, {_WORDS}, {RULES_CTE}"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("column_name"))
    columns = profile.schema_frame(tables(spark, sf_dir, ALL), "raw").select("column_name")
    return words.unionAll(columns).distinct()


@query(f"with {_WORD_CTES} select column_name, {NORMALIZED.format('column_name')} as normalized from words", "normalize_name")
def words_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).withColumn("normalized", normalize_name(F.col("column_name")))


_TOKENS = (
    "words as (select distinct column_name from (select unnest(regexp_extract_all(text, '[A-Za-z]+')) as column_name"
    " from documents union all select column_name from cols))"
)


def _alias_query(spark: SparkSession, sf_dir: str, condition, words: DataFrame | None = None) -> DataFrame:
    """(column_name, category): every rule whose aliases meet the name."""
    words = _words(spark, sf_dir) if words is None else words
    hits = ", ".join(f"case when {condition('normalized', r.aliases)} then '{r.code}' end" for r in seeds.RULES)
    names = words.withColumn("normalized", normalize_name(F.col("column_name")))
    return names.selectExpr("column_name", f"explode(array({hits})) as category").where("category is not null")


@query(f"with {columns_cte(ALL)}, {_TOKENS}, {RULES_CTE} select column_name, code as category from words join rules"
       f" on list_contains(aliases, {NORMALIZED.format('column_name')})")
def alias_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of letters as names: parts of addresses and such are aliases as they stand."""
    tokens = table(spark, sf_dir, "documents").select(
        F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("column_name")
    )
    columns = profile.schema_frame(tables(spark, sf_dir, ALL), "raw").select("column_name")
    return _alias_query(spark, sf_dir, alias_exact_sql, tokens.unionAll(columns).distinct())


@query(f"with {_WORD_CTES} select column_name, code as category from words join rules"
       f" on len(list_filter(aliases, lambda a: contains({NORMALIZED.format('column_name')}, a))) > 0")
def alias_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alias_query(spark, sf_dir, alias_contains_sql)


@query(f"with {_WORD_CTES}, {name_hits_cte('words', 'column_name')} select * from words left join name_hits using (column_name)")
def best_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.match_names(_words(spark, sf_dir))


# --------------------------------------------------------------- patterns

_TEXTS = (
    "texts as (select 'documents' as table_name, text as v from documents union all select 'pages', html from pages"
    " union all select 'conversations', text from conversations union all select 'customer', c_name from customer)"
)


@query(f"""with {RULES_CTE}, {_TEXTS}, {regex_hits_cte('texts', 'table_name', 'v')}
select table_name, max(ratio) filter (code = 'NATIONAL_ID') as ratio_national_id,
  max(ratio) filter (code = 'BANK_ACCOUNT') as ratio_bank_account, max(ratio) filter (code = 'TAX_CODE') as ratio_tax_code,
  max(ratio) filter (code = 'PHONE') as ratio_phone, max(ratio) filter (code = 'EMAIL') as ratio_email
from ratios group by table_name""")
def regex_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"documents": "text", "pages": "html", "conversations": "text", "customer": "c_name"}
    values = profile.union_all(
        [
            table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col(c).alias("v"))
            for t, c in columns.items()
        ]
    )
    return classify.regex_ratios(values, ["table_name"], "v")


@query(f"with {RULES_CTE}, {regex_hits_cte('documents', 'source, lang', 'text')} select * from regex_hits")
def best_regex_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = classify.regex_ratios(table(spark, sf_dir, "documents"), ["source", "lang"], "text")
    return classify.match_patterns(ratios).where("regex_category is not null")


# ---------------------------------------------------------- classification

_EVIDENCE = ", ".join(
    [columns_cte(ALL), samples_cte(ALL), RULES_CTE, name_hits_cte(), regex_hits_cte(), COMBINED_CTE]
)
_RESULT = "table_name, column_name, category, confidence, detection_method, sensitivity"


@query(f"with {_EVIDENCE} select {_RESULT} from combined")
def combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.detect(*profiled(spark, sf_dir, ALL))
    return classify.combine(found).select(*_RESULT.split(", "))


@query(f"with {_EVIDENCE}, {CLASSIFIED_CTE} select {_RESULT} from classified where confidence < 0.7")
def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.combine(classify.detect(*profiled(spark, sf_dir, ALL)))
    return classify.apply_threshold(found).where("confidence < 0.7D").select(*_RESULT.split(", "))


@query(f"with {classified_ctes(ALL)} select {_RESULT} from classified")
def classify_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(*profiled(spark, sf_dir, list(TABLES))).select(*_RESULT.split(", "))
