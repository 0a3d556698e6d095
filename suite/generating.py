"""Generated fixture tables: one row per row of a given table, recomputed in DuckDB."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.draws import ROW_ID, Draws
from lakeveil.operators import generate as gen
from lakeveil.plans.schemas import SCHEMAS
from lakeveil.sources import dimensions as dim
from suite.base import query, table

AS_OF = dt.date(2026, 1, 1)
SEED = 42
# Which table's keys give the row ids of which fixture.
ID_COLUMNS = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "part": "p_partkey"}
SOURCES = {
    "citizen_info": "customer",
    "administrative_record": "orders",
    "transaction_log": "events",
    "hr_employee": "part",
}


def ids(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name).select(ID_COLUMNS[name])


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gen.generate_for(ids(spark, sf_dir, SOURCES[name]), name, SEED, AS_OF)


# ---------------------------------------------------------------- DuckDB text
# d0, d1, ... are the row's digests; each draw reads a part of one of them.


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _number(digest: int, part: int, width: int = 8) -> str:
    return f"(('0x' || substr(d{digest}, {part * 8 + 1}, {width}))::bigint)"


def _pick(values: list[str], digest: int, part: int) -> str:
    return f"{_list(values)}[{_number(digest, part)} % {len(values)} + 1]"


def _unit(digest: int, part: int) -> str:
    return f"({_number(digest, part)} / 4294967296.0::double)"


def _digits(width: int, digest: int, part: int) -> str:
    return f"lpad(({_number(digest, part, 14)} % {10**width})::varchar, {width}, '0')"


def _name(*places: tuple[int, int]) -> str:
    lists = (dim.FAMILY_NAMES, dim.MIDDLE_NAMES, dim.GIVEN_NAMES)
    return "concat_ws(' ', " + ", ".join(_pick(words, *place) for words, place in zip(lists, places)) + ")"


def _phone(prefix: tuple[int, int], digits: tuple[int, int]) -> str:
    return f"({_pick(['03', '05', '07', '08', '09'], *prefix)} || {_digits(8, *digits)})"


def _email(local: tuple[int, int], digits: tuple[int, int], domain: tuple[int, int]) -> str:
    return (
        f"({_pick(dim.MAIL_NAMES, *local)} || {_digits(4, *digits)} || '@' || {_pick(dim.MAIL_DOMAINS, *domain)})"
    )


def _account(length: tuple[int, int], digits: tuple[int, int]) -> str:
    return f"substr({_digits(14, *digits)}, 1, [10, 12, 13, 14][{_number(*length)} % 4 + 1])"


def _tax(kind: tuple[int, int], digits: tuple[int, int], plain: float = 0.7) -> str:
    twelve = _digits(12, *digits)
    return (
        f"case when {_unit(*kind)} < {plain}::double then substr({twelve}, 1, 10)"
        f" else substr({twelve}, 1, 9) || '-' || substr({twelve}, 10, 3) end"
    )


def _rows(name: str, digests: int) -> str:
    """rows(row_id, d0, d1, ...)"""
    source = SOURCES[name]
    columns = ", ".join(f"md5('{SEED}|{name}|{i}|' || {ID_COLUMNS[source]}::varchar) as d{i}" for i in range(digests))
    return f"rows as (select {ID_COLUMNS[source]} as row_id, {columns} from {source})"


def _rendered(text: str, values: dict[str, str]) -> str:
    for key, value in values.items():
        text = f"replace({text}, '${{{key}}}', {value})"
    return text


_FIRST, _SECOND = _list(dim.WARD_FIRST), _list(dim.WARD_SECOND)
_WARD_NAME = (
    f"['Phường', 'Xã'][w % 2 + 1] || ' ' || {_FIRST}[w // 2 % 12 + 1] || ' ' || {_SECOND}[w // 24 % 11 + 1]"
    " || ' ' || (w // 264 + 1)"
)
_PROVINCE_NAME = f"{_list(list(dim.PROVINCES.values()))}[w % 34 + 1]"
_OLDEST = "(date '2008-01-01' - date '1926-01-01')"
_BIRTH = f"date '2008-01-01' - floor({_unit(3, 3)} * {_OLDEST})::int"
_STREET_LINE = f"(({_number(4, 2)} % 999) + 1)::varchar || ' ' || {_pick(dim.STREETS, 4, 3)}"
_ADDRESS = f"{_STREET_LINE} || ', ' || {_WARD_NAME} || ', ' || {_PROVINCE_NAME}"

CITIZEN_SQL = f"""with {_rows('citizen_info', 5)}, warded as (select *, {_number(4, 1)} % 3321 as w from rows),
citizens as (select (row_id + 1)::int as citizen_id, {_name((0, 0), (0, 1), (0, 2))} as full_name,
  '0' || {_digits(11, 1, 0)} as national_id, {_phone((1, 2), (2, 0))} as phone_number,
  {_email((2, 2), (3, 0), (3, 2))} as email, {_BIRTH} as birth_date, {_ADDRESS} as address,
  {_pick(dim.JOBS, 4, 0)} as occupation from warded)"""

_NOTE_INDEX = f"{_number(0, 0)} % {len(dim.CLERK_NOTES)}"
_NOTE = _rendered(
    f"{_list(dim.CLERK_NOTES)}[{_NOTE_INDEX} + 1]",
    {
        "bank_account": _account((1, 3), (2, 0)),
        "email": _email((2, 2), (3, 0), (3, 2)),
        "full_name": _name((3, 3), (4, 0), (4, 1)),
        "national_id": f"'0' || {_digits(11, 4, 2)}",
        "phone_number": _phone((5, 0), (5, 1)),
    },
)
RECORD_SQL = f"""with {_rows('administrative_record', 6)},
records as (select (row_id + 1)::int as record_id,
  {_list(dim.SERVICE_TYPES)}[{_NOTE_INDEX} // {len(dim.RECORD_STATUSES)} + 1] as service_type,
  {_name((0, 1), (0, 2), (0, 3))} as applicant_name, '0' || {_digits(11, 1, 0)} as cccd_number,
  date '2026-01-01' - ({_number(1, 2)} % 731)::int as submission_date,
  {_list(dim.RECORD_STATUSES)}[{_NOTE_INDEX} % {len(dim.RECORD_STATUSES)} + 1] as status, {_NOTE} as clerk_notes from rows)"""

_MESSAGE = _rendered(
    f"{_list(dim.TX_MESSAGES)}[{_number(0, 0)} % {len(dim.TX_MESSAGES)} + 1]",
    {
        "bank_account": _account((5, 1), (5, 2)),
        "email": _email((6, 0), (6, 1), (6, 3)),
        "phone_number": _phone((7, 0), (7, 1)),
        "tax_id": _tax((7, 3), (8, 0)),
    },
)
_FRAUD = _rendered(
    f"{_list(dim.FRAUD_NOTES)}[{_number(0, 1)} % {len(dim.FRAUD_NOTES)} + 1]",
    {
        "bank_account": _account((8, 2), (9, 0)),
        "email": _email((9, 2), (10, 0), (10, 2)),
        "national_id": f"'0' || {_digits(11, 11, 0)}",
        "phone_number": _phone((11, 2), (12, 0)),
        "tax_id": _tax((12, 2), (13, 0)),
    },
)
TX_SQL = f"""with {_rows('transaction_log', 14)},
transactions as (select (row_id + 1)::int as tx_id,
  (timestamp '2026-01-01 00:00:00' - to_seconds({_number(0, 3)} % 63072000))::varchar as tx_timestamp,
  {_pick(dim.TX_TYPES, 1, 0)} as tx_type, round(10000 + {_unit(1, 1)} * 499990000, -3) as amount,
  {_account((1, 2), (2, 0))} as source_account, {_account((2, 2), (3, 0))} as target_account,
  {_tax((3, 2), (4, 0))} as tax_id, {_name((4, 2), (4, 3), (5, 0))} as customer_name, {_MESSAGE} as tx_message,
  case when {_unit(0, 2)} <= 0.008::double then {_FRAUD} end as fraud_notes from rows)"""

_REMARK = _rendered(
    f"{_list(dim.HR_REMARKS)}[{_number(0, 0)} % {len(dim.HR_REMARKS)} + 1]",
    {
        "bank_account": _account((4, 2), (5, 0)),
        "email": _email((5, 2), (6, 0), (6, 2)),
        "emergency_name": _name((6, 3), (7, 0), (7, 1)),
        "national_id": f"'0' || {_digits(11, 7, 2)}",
        "phone_number": _phone((8, 0), (8, 1)),
        "tax_id": _tax((8, 3), (9, 0)),
    },
)
HR_SQL = f"""with {_rows('hr_employee', 10)},
employees as (select (row_id + 1)::int as employee_id, {_pick(dim.DEPARTMENTS, 0, 1)} as department,
  {_pick(dim.JOBS, 0, 2)} as job_title, {_name((0, 3), (1, 0), (1, 1))} as c01,
  round(5000000 + {_unit(1, 2)} * 75000000, -3) as c02, {_account((1, 3), (2, 0))} as c03,
  {_tax((2, 2), (3, 0), 0.8)} as c04, {_phone((3, 2), (4, 0))} as c05, {_REMARK} as remarks from rows)"""


def _text_dates(df: DataFrame) -> DataFrame:
    """Dates and times as text: the engines' clients type them differently."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.col(c).cast("string").alias(c) if kinds[c] in ("date", "timestamp") else F.col(c) for c in df.columns]
    )


@query(f"{CITIZEN_SQL} select * replace (birth_date::date::varchar as birth_date) from citizens")
def gen_citizen_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_dates(fixture(spark, sf_dir, "citizen_info"))


@query(f"{RECORD_SQL} select * replace (submission_date::date::varchar as submission_date) from records")
def gen_administrative_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_dates(fixture(spark, sf_dir, "administrative_record"))


@query(f"{TX_SQL} select * from transactions")
def gen_transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_dates(fixture(spark, sf_dir, "transaction_log"))


@query(f"{HR_SQL} select * from employees")
def gen_hr_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "hr_employee")


# ------------------------------------------------------------ value shapes


def _drawn(spark: SparkSession, sf_dir: str, draws: Draws, **columns: str) -> DataFrame:
    """Free draws over the customers, under a name of their own."""
    rows = draws.attach(ids(spark, sf_dir, "customer").toDF(ROW_ID), SEED, "shapes")
    return rows.selectExpr(ROW_ID, *[f"{e} as {n}" for n, e in columns.items()])


def _shapes_sql(digests: int, **columns: str) -> str:
    parts = ", ".join(f"md5('42|shapes|{i}|' || c_custkey::varchar) as d{i}" for i in range(digests))
    shown = ", ".join(f"{e} as {n}" for n, e in columns.items())
    return f"with rows as (select c_custkey as row_id, {parts} from customer) select row_id, {shown} from rows"


@query(_shapes_sql(3, national_id=f"'0' || {_digits(11, 0, 0)}", account=_account((0, 2), (1, 0)),
                   phone=_phone((1, 2), (2, 0))))
def gen_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = Draws()
    return _drawn(
        spark,
        sf_dir,
        draws,
        national_id=gen.national_id(draws),
        account=gen.bank_account(draws),
        phone=gen.phone_number(draws),
    )


@query(_shapes_sql(2, tax_id=_tax((0, 0), (0, 1)), hr_tax_id=_tax((0, 3), (1, 0), 0.8)))
def gen_tax_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = Draws()
    return _drawn(
        spark, sf_dir, draws, tax_id=gen.tax_id(draws), hr_tax_id=gen.tax_id(draws, gen.HR_TAX_ID_PLAIN)
    )


@query(_shapes_sql(1, amount=f"round(10000 + {_unit(0, 0)} * 499990000, -3)",
                   salary=f"round(5000000 + {_unit(0, 1)} * 75000000, -3)"))
def gen_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = Draws()
    return _drawn(
        spark,
        sf_dir,
        draws,
        amount=gen.amount(draws, *gen.AMOUNT_RANGE),
        salary=gen.amount(draws, *gen.SALARY_RANGE),
    )


@query(f"{TX_SQL} select count(*) as transactions, count(fraud_notes) as fraud_notes from transactions")
def gen_sparse_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "transaction_log").selectExpr(
        "count(1) as transactions", "count(fraud_notes) as fraud_notes"
    )


@query(f"{RECORD_SQL} select record_id, clerk_notes from records union all select 0, x from (select unnest(["
       "'unfilled ' || (select count(*) from records where clerk_notes like '%${%')]) as x)")
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered notes, and a last row that counts placeholders left over."""
    notes = fixture(spark, sf_dir, "administrative_record").select("record_id", "clerk_notes")
    left = notes.agg(F.count_if(F.col("clerk_notes").contains("${")).alias("n"))
    return notes.unionAll(left.select(F.lit(0), F.concat(F.lit("unfilled "), F.col("n").cast("string"))))


@query(f"{CITIZEN_SQL} select citizen_id, address from citizens")
def gen_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "citizen_info").select("citizen_id", "address")


@query(f"{HR_SQL} select department, count(*) as employees from employees group by department")
def gen_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "hr_employee").groupBy("department").agg(F.count(F.lit(1)).alias("employees"))


@query(f"select {_WARD_NAME} as ward_name, {_PROVINCE_NAME} as province_name, count(*) as customers"
       " from (select c_custkey % 3321 as w from customer) group by all")
def join_address_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per ward and province of the address pool."""
    placed = ids(spark, sf_dir, "customer").selectExpr(f"c_custkey % {dim.WARD_COUNT} as ward_index")
    return (
        placed.join(F.broadcast(dim.address_pool(spark)), "ward_index")
        .groupBy("ward_name", "province_name")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


# The first province code of each run of a region, as an independent list.
_REGION_OF = (
    "case when c < '04' then 'Northern plain' when c < '24' then 'Northern uplands' when c < '38' then 'Northern plain'"
    " when c < '52' then 'Central coast' when c < '56' then 'Central uplands' when c < '66' then 'Central coast'"
    " when c < '75' then 'Central uplands' else 'Southern plain' end"
)


@query(f"""with placed as (select c_custkey % 3321 as w, {_list(list(dim.PROVINCES))}[w % 34 + 1] as c,
  if({_PROVINCE_NAME} like 'Thành phố %', 'City', 'Province') as province_unit, if(w % 2 = 0, 'Ward', 'Commune') as ward_unit
  from customer),
regions(region) as (values {', '.join(f"('{r}')" for r in dim.REGIONS)}),
chained as (select regions.region, p.w, p.province_unit, p.ward_unit
  from regions left join (select *, {_REGION_OF} as region from placed) p using (region))
select region, province_unit, ward_unit, grouping(region, province_unit, ward_unit) as level, count(w) as customers
from chained group by rollup (region, province_unit, ward_unit)""")
def dimension_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by region, kind of province and kind of ward; regions without wards have a row too."""
    placed = ids(spark, sf_dir, "customer").selectExpr(f"c_custkey % {dim.WARD_COUNT} as ward_index")
    # Counted per ward before the regions join, so that the roll-up works on 3,321 rows at most.
    per_ward = placed.groupBy("ward_index").agg(F.count(F.lit(1)).alias("n"))
    chained = F.broadcast(dim.ward_chain(spark)).join(per_ward, "ward_index")
    every = dim.regions(spark).select("region").join(chained, "region", "left")
    rolled = every.rollup("region", "province_unit", "ward_unit")
    return rolled.agg(
        F.grouping_id().cast("long").alias("level"), F.coalesce(F.sum("n"), F.lit(0)).alias("customers")
    )


@query(f"{RECORD_SQL} select service_type, status, count(*) as records from records group by all")
def join_note_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per service and status of the note pool."""
    draws = Draws()
    index = draws.below(len(dim.CLERK_NOTES))
    rows = draws.attach(ids(spark, sf_dir, "orders").toDF(ROW_ID), SEED, "administrative_record")
    placed = rows.selectExpr(f"{index} as template_index").join(F.broadcast(dim.note_pool(spark)), "template_index")
    return placed.groupBy("service_type", "status").agg(F.count(F.lit(1)).alias("records"))


# How many entries each dimension has.
_ENTRIES = {
    "administrative_regions": 6, "administrative_units": 4, "provinces": 34, "wards": 3321, "service_types": 4,
    "record_statuses": 6, "clerk_notes_templates": 24, "tx_types": 7, "tx_message_templates": 9,
    "fraud_note_templates": 8, "departments": 7, "hr_remarks_templates": 11,
}
_ENTRY_ROWS = ", ".join(f"('{k}', {v}::bigint)" for k, v in _ENTRIES.items())


@query(f"""{HR_SQL}, used as (select 'departments' as dimension, count(distinct department) as used from employees
union all select 'hr_remarks_templates', count(distinct {_number(0, 0)} % {len(dim.HR_REMARKS)}) from rows)
select dimension, entries, used from (values {_ENTRY_ROWS}) e(dimension, entries) left join used using (dimension)""")
def dimension_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions, and how many entries of the HR ones the generated employees use."""
    draws = Draws()
    index = draws.below(len(dim.HR_REMARKS))
    rows = draws.attach(ids(spark, sf_dir, "part").toDF(ROW_ID), SEED, "hr_employee")
    remarks = rows.agg(F.count_distinct(F.expr(index)).alias("used"))
    departments = fixture(spark, sf_dir, "hr_employee").agg(F.count_distinct("department").alias("used"))
    used = departments.select(F.lit("departments").alias("dimension"), "used").unionAll(
        remarks.select(F.lit("hr_remarks_templates"), "used")
    )
    return dim.dimension_entries(spark).join(used, "dimension", "left").select("dimension", "entries", "used")


@query(f"{HR_SQL} select 'hr_employee' as table_name, k as column_name, t as data_type, n as non_null from (select unnest(["
       "{'k': 'employee_id', 't': 'int', 'n': count(employee_id)}, {'k': 'department', 't': 'string', 'n': count(department)},"
       "{'k': 'job_title', 't': 'string', 'n': count(job_title)}, {'k': 'c01', 't': 'string', 'n': count(c01)},"
       "{'k': 'c02', 't': 'double', 'n': count(c02)}, {'k': 'c03', 't': 'string', 'n': count(c03)},"
       "{'k': 'c04', 't': 'string', 'n': count(c04)}, {'k': 'c05', 't': 'string', 'n': count(c05)},"
       "{'k': 'remarks', 't': 'string', 'n': count(remarks)}], recursive := true) from employees)")
def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared schema, with how many generated values each column holds."""
    fields = SCHEMAS["hr_employee"].fields
    counted = fixture(spark, sf_dir, "hr_employee").selectExpr(*[f"count({f.name}) as {f.name}" for f in fields])
    kinds = ", ".join(f"struct('{f.name}' as column_name, '{f.dataType.simpleString()}' as data_type, {f.name} as non_null)"
                      for f in fields)
    return counted.selectExpr("'hr_employee' as table_name", f"inline(array({kinds}))")
