"""Masks, access plans and governed reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions import masks
from lakeveil.operators import catalogue, classify, governed, policy
from lakeveil.operators.generate import generate_for
from lakeveil.operators.governed import ColumnAction
from lakeveil.operators.profile import union_all
from lakeveil.plans import jobs, seeds
from lakeveil.sources.ingest import raise_on_failure
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import new_folder
from lakeveil.streaming.governed_stream import write_governed
from suite.base import (
    ALL,
    POLICIES_CTE,
    classified_ctes,
    email_sql,
    governed_store,
    keep_ends_sql,
    partial_sql,
    profiled,
    query,
    raw_namespace,
    table,
)
from suite.generating import AS_OF, CITIZEN_SQL, ids

# ------------------------------------------------------------------- masks


@query(f"select doc_id, {partial_sql('text')} as text, {partial_sql('lang')} as lang from documents")
def mask_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", masks.partial_mask("text").alias("text"), masks.partial_mask("lang").alias("lang")
    )


@query("select o_orderkey, sha256(o_custkey::varchar) as o_custkey, sha256(o_orderpriority) as o_orderpriority"
       " from orders")
def mask_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        masks.hash_mask("o_custkey").alias("o_custkey"),
        masks.hash_mask("o_orderpriority").alias("o_orderpriority"),
    )


@query("select doc_id, case when nullif(lang, 'en') is not null then '[REDACTED]' end as lang from documents")
def mask_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    foreign = F.nullif(F.col("lang"), F.lit("en"))
    return table(spark, sf_dir, "documents").select("doc_id", masks.redact_mask(foreign).alias("lang"))


@query("select c_custkey, cast(null as varchar) as c_acctbal from customer")
def mask_nullify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", masks.nullify_mask("c_acctbal").alias("c_acctbal"))


_EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"


@query(f"select doc_id, {email_sql('v')} as email from (select doc_id, unnest(regexp_extract_all(text, '{_EMAIL}')) as v"
       f" from documents union all select doc_id, source as v from documents)")
def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses found in the documents, and sources as values without an @."""
    documents = table(spark, sf_dir, "documents")
    with_at = documents.where(F.col("text").contains("@"))
    found = with_at.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_EMAIL), F.lit(0))).alias("v"))
    values = found.unionAll(documents.select("doc_id", "source"))
    return values.select("doc_id", masks.email_mask("v").alias("email"))


@query(f"{CITIZEN_SQL} select citizen_id, {keep_ends_sql('phone_number', 3, 2)} as phone_number from citizens")
def mask_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    citizens = generate_for(ids(spark, sf_dir, "customer"), "citizen_info", as_of=AS_OF)
    return citizens.select("citizen_id", masks.phone_mask("phone_number").alias("phone_number"))


@query(f"{CITIZEN_SQL} select citizen_id, {keep_ends_sql('national_id', 3, 4)} as national_id from citizens")
def mask_national_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    citizens = generate_for(ids(spark, sf_dir, "customer"), "citizen_info", as_of=AS_OF)
    return citizens.select("citizen_id", masks.national_id_mask("national_id").alias("national_id"))


@query(f"{CITIZEN_SQL} select citizen_id, {email_sql('email')} as email,"
       f" {keep_ends_sql('phone_number', 3, 2)} as phone_number, {keep_ends_sql('national_id', 3, 4)} as national_id,"
       f" {partial_sql('full_name')} as full_name, sha256(address) as address, '[REDACTED]' as occupation"
       " from citizens")
def mask_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    citizens = generate_for(ids(spark, sf_dir, "customer"), "citizen_info", as_of=AS_OF)
    partial = {"email": "EMAIL", "phone_number": "PHONE", "national_id": "NATIONAL_ID", "full_name": "FULL_NAME"}
    return citizens.select(
        "citizen_id",
        *[masks.mask_column(c, "PARTIAL_MASK", category).alias(c) for c, category in partial.items()],
        masks.mask_column("address", "HASH_MASK", "EMAIL").alias("address"),
        masks.mask_column("occupation", "REDACT", "PHONE").alias("occupation"),
    )


@query("select c_custkey, substr(c_name, 1, 1) || repeat('#', length(c_name) - 1) as c_name,"
       " substr(c_name, 1, 3) || repeat('$', length(c_name) - 5) || right(c_name, 2) as as_phone from customer")
def mask_replace_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        masks.partial_mask("c_name", "#").alias("c_name"),
        masks.phone_mask("c_name", "$").alias("as_phone"),
    )


# ------------------------------------------------------------------ policy

_CLASSIFIED = classified_ctes(ALL)
_PLAN = (
    f"with {_CLASSIFIED}, {POLICIES_CTE}, fanned as (select unnest(['ADMIN', 'ANALYST', 'AUDITOR']) as role_name, *"
    " from classified), plan as (select f.role_name, f.namespace, f.table_name, f.column_name, f.category, f.sensitivity,"
    " coalesce(p.action, 'ALLOW') as action, p.masking_function from fanned f left join policies p"
    " on p.role_name = f.role_name and p.sensitivity = f.sensitivity)"
)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(*profiled(spark, sf_dir, ALL))


def _plan(spark: SparkSession, sf_dir: str, roles: list[str]) -> DataFrame:
    return policy.access_plan(_classified(spark, sf_dir), seeds.access_policies(spark), roles)


@query(f"{_PLAN} select * from plan where role_name = 'ANALYST'")
def access_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, ["ANALYST"])


@query(f"{_PLAN} select * from plan where role_name = 'AUDITOR' and table_name = 'customer' and column_name = 'c_name'")
def plan_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.plan_lookup(_plan(spark, sf_dir, ["AUDITOR"]), "customer", "c_name")


@query(f"{_PLAN} select * from plan")
def plan_all_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, seeds.ROLES)


_GOVERNED_COUNT = (
    "select p.role_name, p.sensitivity, p.action, p.masking_function, count(c.column_name) as columns_governed"
    " from policies p left join classified c using (sensitivity) {} group by all"
)


def _with_columns_governed(policies: DataFrame, classified: DataFrame) -> DataFrame:
    """Each policy with the number of classified columns it governs."""
    counts = classified.groupBy("sensitivity").agg(F.count(F.lit(1)).alias("n"))
    return policies.join(counts, "sensitivity", "left").select(
        "role_name", "sensitivity", "action", "masking_function", F.coalesce("n", F.lit(0)).alias("columns_governed")
    )


@query(f"with {_CLASSIFIED}, {POLICIES_CTE} {_GOVERNED_COUNT.format('')}")
def policy_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_columns_governed(seeds.access_policies(spark), _classified(spark, sf_dir))


_WHERE_AUDITOR = "where p.role_name = 'AUDITOR'"
_WHERE_POINT = "where p.role_name = 'ANALYST' and p.sensitivity = 'HIGH'"


@query(f"with {_CLASSIFIED}, {POLICIES_CTE} {_GOVERNED_COUNT.format(_WHERE_AUDITOR)}")
def policies_for_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = policy.policies_for_role(seeds.access_policies(spark), seeds.roles(spark), "AUDITOR")
    return _with_columns_governed(policies, _classified(spark, sf_dir))


@query(f"with {_CLASSIFIED}, {POLICIES_CTE} {_GOVERNED_COUNT.format(_WHERE_POINT)}")
def access_policy_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = policy.access_policy_point(seeds.access_policies(spark), "ANALYST", "HIGH")
    return _with_columns_governed(point, _classified(spark, sf_dir))


# ------------------------------------------------------------ governed reads


def _two_namespaces(spark: SparkSession, sf_dir: str) -> tuple[MetadataStore, list[str]]:
    """One store; a namespace with the customers and one with the suppliers, each catalogued and scanned in turn."""
    store = MetadataStore(spark, f"gov_{uuid.uuid4().hex[:12]}")
    store.open(new_folder(spark, store.namespace))
    names = [raw_namespace(spark, sf_dir, ["customer", "nation"]), raw_namespace(spark, sf_dir, ["supplier", "part"])]
    for name in names:
        raise_on_failure(jobs.catalogue_namespace(spark, store, name, reuse_samples=True))
        jobs.scan_namespace(spark, store, name, strict=True, reuse_samples=True)
    return store, names


@query("select 'customer' as table_name, sha256(c_custkey::varchar) as id, sha256(c_name) as name, c_nationkey as nation,"
       " c_acctbal as balance from customer union all select 'supplier', s_suppkey::varchar, sha256(s_name), s_nationkey,"
       f" s_acctbal from supplier union all select 'part', p_partkey::varchar, {partial_sql('p_name')}, p_size,"
       " p_retailprice from part")
def governed_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an analyst sees of both namespaces after the second one was scanned."""
    store, (first, second) = _two_namespaces(spark, sf_dir)
    shown = [
        jobs.governed_table(spark, store, first, "customer", "ANALYST").select(
            F.lit("customer"), "c_custkey", "c_name", "c_nationkey", "c_acctbal"),
        jobs.governed_table(spark, store, second, "supplier", "ANALYST").select(
            F.lit("supplier"), F.col("s_suppkey").cast("string"), "s_name", "s_nationkey", "s_acctbal"),
        jobs.governed_table(spark, store, second, "part", "ANALYST").select(
            F.lit("part"), F.col("p_partkey").cast("string"), "p_name", "p_size", "p_retailprice"),
    ]
    return union_all(shown).toDF("table_name", "id", "name", "nation", "balance")


_HASH, _STARS = "sha256({0}::varchar)", "'[REDACTED]'"


def _views_sql() -> str:
    """Customers with their orders by role: the join goes over the masked keys where they keep equality."""
    parts = []
    for role, key, name in (("ADMIN", "{0}::varchar", "c_name"), ("ANALYST", _HASH, _HASH.format("c_name"))):
        parts.append(
            f"select '{role}' as role_name, {key.format('c_custkey')} as c_custkey, {name} as c_name, c_mktsegment,"
            " count(o_orderkey) as orders from customer left join orders on o_custkey = c_custkey group by all"
        )
    parts.append(f"select 'AUDITOR', {_STARS}, {_STARS}, c_mktsegment, count(*) from customer group by all")
    return " union all ".join(parts)


@query(_views_sql())
def governed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permanent views per role, queried as SQL text."""
    store, raw = governed_store(spark, sf_dir)
    frames = []
    for role in seeds.ROLES:
        views = f"{raw}_{role.lower()}"
        jobs.publish_views(spark, store, raw, role, views)
        if role == "AUDITOR":
            text = f"SELECT c_custkey, c_name, c_mktsegment, count(1) AS orders FROM {views}.customer GROUP BY ALL"
        else:
            text = (
                "SELECT cast(c_custkey AS string) AS c_custkey, c_name, c_mktsegment, count(o_orderkey) AS orders"
                f" FROM {views}.customer LEFT JOIN {views}.orders ON o_custkey = c_custkey GROUP BY ALL"
            )
        frames.append(spark.sql(text).select(F.lit(role).alias("role_name"), "*"))
    return union_all(frames)


def _governed(spark: SparkSession, sf_dir: str, name: str, role: str, columns: list[str] | None = None) -> DataFrame:
    """The table as the role sees it, by the plan in the stored catalogue."""
    store, raw = governed_store(spark, sf_dir)
    return jobs.governed_table(spark, store, raw, name, role, columns)


@query("select sha256(c_custkey::varchar) as c_custkey, sha256(c_name) as c_name, c_nationkey, c_acctbal, c_mktsegment"
       " from customer")
def governed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "customer", "ANALYST")


@query("select * from supplier")
def governed_allow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "supplier", "ADMIN")


@query("select s_suppkey, '[REDACTED]' as s_name, s_nationkey, s_acctbal from supplier")
def governed_auditor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "supplier", "AUDITOR")


@query(f"select p_partkey, {partial_sql('p_name')} as p_name, p_brand, p_type, p_size, p_retailprice from part")
def governed_analyst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "part", "ANALYST")


_CUSTOM = {
    "doc_id": ColumnAction("doc_id", "MASK", "HASH_MASK"),
    "text": ColumnAction("text", "MASK", "PARTIAL_MASK", "EMAIL"),
    "lang": ColumnAction("lang", "MASK", "REDACT"),
    "source": ColumnAction("source", "MASK", "NULLIFY"),
    "n_chars": ColumnAction("n_chars", "MASK", "SHUFFLE"),
}


@query(f"select sha256(doc_id::varchar) as doc_id, {email_sql('text')} as text, '[REDACTED]' as lang,"
       " cast(null as varchar) as source, cast(null as varchar) as n_chars from documents")
def governed_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every function once, and one that does not exist."""
    return governed.govern(table(spark, sf_dir, "documents"), _CUSTOM)


@query("select o_orderkey, o_orderstatus, o_orderdate::varchar as o_orderdate from orders")
def governed_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = ("o_custkey", "o_totalprice", "o_orderpriority")
    seen = governed.govern(table(spark, sf_dir, "orders"), {c: ColumnAction(c, "DENY") for c in denied})
    return seen.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("select c_mktsegment, sha256(c_name) as c_name, c_acctbal from customer")
def governed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "customer", "ANALYST", ["c_mktsegment", "c_name", "c_acctbal"])


@query("select 'allow' as unknown, event_id, sha256(user_id::varchar) as user_id, event_type from events"
       " union all select 'deny', null, sha256(user_id::varchar), null from events")
def governed_uncatalogued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without a plan pass by default and are left out in strict mode."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    plan = {"user_id": ColumnAction("user_id", "MASK", "HASH_MASK")}
    passed = governed.govern(events, plan).withColumn("unknown", F.lit("allow"))
    strict = governed.govern(events, plan, unknown="deny").withColumn("unknown", F.lit("deny"))
    return passed.unionByName(strict, allowMissingColumns=True)


def _masked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _governed(spark, sf_dir, "orders", "ANALYST", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("select o_orderkey, sha256(o_custkey::varchar) as o_custkey, o_totalprice, sha256(c_custkey::varchar) as c_custkey,"
       " c_mktsegment from orders join customer on sha256(o_custkey::varchar) = sha256(c_custkey::varchar)")
def governed_hash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _governed(spark, sf_dir, "customer", "ANALYST", ["c_custkey", "c_mktsegment"])
    return governed.masked_join(_masked_orders(spark, sf_dir), customers, "o_custkey", "c_custkey")


@query("select a.o_orderkey, a.o_custkey, b.orders from (select o_orderkey, sha256(o_custkey::varchar) as o_custkey from"
       " orders) a left join (select sha256(o_custkey::varchar) as o_custkey, count(*) as orders from orders"
       " where o_totalprice > 200000 group by 1) b using (o_custkey)")
def governed_same_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outer join whose key has one name on both sides: each order with its customer's large orders."""
    orders = _masked_orders(spark, sf_dir)
    large = governed.group_by_masked(orders.where("o_totalprice > 200000"), "o_custkey", orders="count(1)")
    met = governed.masked_join(orders, large, "o_custkey", "o_custkey", "left")
    return met.select("l.o_orderkey", "l.o_custkey", "r.orders")


@query(f"with {POLICIES_CTE} select role_name, sensitivity, action, masking_function,"
       " (case role_name when 'ADMIN' then 1 when 'ANALYST' then 2 else 3 end)::int as role_name_id,"
       " (case masking_function when 'PARTIAL_MASK' then 1 when 'HASH_MASK' then 2 when 'REDACT' then 3"
       " when 'NULLIFY' then 4 end)::int as masking_function_id, (select count(*) from customer) as customers from policies")
def policy_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies of the stored catalogue with the ids of their role and masking function, next to the rows they guard."""
    store, raw = governed_store(spark, sf_dir)
    found = catalogue.policies_with_ids(*[store.read(t) for t in ("access_policies", "roles", "masking_functions")])
    customers = spark.table(f"{raw}.customer").count()
    return found.select(
        "role_name", "sensitivity", "action", "masking_function", "role_name_id", "masking_function_id",
        F.lit(customers).alias("customers"),
    )


@query("select sha256(o_custkey::varchar) as o_custkey, count(*) as orders,"
       " round(sum(o_totalprice::decimal(18,2)), 2)::double as total from orders group by 1")
def governed_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governed.group_by_masked(
        _masked_orders(spark, sf_dir), "o_custkey", orders="count(1)", total="cast(sum(cast(o_totalprice as decimal(18,2))) as double)"
    )


@query("select event_id, sha256(user_id::varchar) as user_id, substr(event_type, 1, 1) ||"
       " repeat('*', length(event_type) - 1) as event_type from events")
def governed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, masked on the way into a Parquet sink."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    plan = {
        "event_id": ColumnAction("event_id"),
        "user_id": ColumnAction("user_id", "MASK", "HASH_MASK"),
        "event_type": ColumnAction("event_type", "MASK", "PARTIAL_MASK"),
    }
    folder = new_folder(spark, "governed-stream")
    run = write_governed(stream, plan, f"{folder}/out", f"{folder}/checkpoint", ["event_id", "user_id", "event_type"])
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out")
