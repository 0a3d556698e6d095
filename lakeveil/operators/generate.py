"""Fixture tables full of personal data, generated as Spark jobs.

Each row is a pure function of (seed, row id): generation is one projection
over ``spark.range`` or over the ids of an existing table, plus broadcast joins
with fixed-size dimensions. No shuffle, no driver loop, any number of rows.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.draws import ROW_ID, Draws
from lakeveil.functions.sqltext import string
from lakeveil.plans.schemas import SCHEMAS
from lakeveil.sources import dimensions as dim

# Value shapes of the generated columns.
PHONE_PREFIXES = ["03", "05", "07", "08", "09"]
ACCOUNT_LENGTHS = [10, 12, 13, 14]
FRAUD_NOTE_PROBABILITY = 0.008
TAX_ID_PLAIN = 0.7
HR_TAX_ID_PLAIN = 0.8
AMOUNT_RANGE = (10_000, 500_000_000)
SALARY_RANGE = (5_000_000, 80_000_000)
HISTORY_DAYS = 730
AGE_RANGE = (18, 100)

DEFAULT_SEED = 42


def national_id(draws: Draws) -> str:
    """12 digits, the first a 0."""
    return f"concat('0', {draws.digits(11)})"


def phone_number(draws: Draws) -> str:
    return f"concat({draws.pick(PHONE_PREFIXES)}, {draws.digits(8)})"


def bank_account(draws: Draws) -> str:
    """10, 12, 13 or 14 digits."""
    lengths = f"array({', '.join(map(str, ACCOUNT_LENGTHS))})"
    length = f"element_at({lengths}, cast({draws.below(len(ACCOUNT_LENGTHS))} as int) + 1)"
    return f"substring({draws.digits(14)}, 1, {length})"


def tax_id(draws: Draws, plain: float = TAX_ID_PLAIN) -> str:
    """10 digits, or 9 digits, a dash and 3 digits."""
    kind, digits = draws.unit(), draws.digits(12)
    with_branch = f"overlay({digits} placing '-' from 10 for 0)"
    return f"case when {kind} < {plain}D then substring({digits}, 1, 10) else {with_branch} end"


def full_name(draws: Draws) -> str:
    words = (dim.FAMILY_NAMES, dim.MIDDLE_NAMES, dim.GIVEN_NAMES)
    return f"concat_ws(' ', {', '.join(draws.pick(w) for w in words)})"


def email(draws: Draws) -> str:
    return f"concat({draws.pick(dim.MAIL_NAMES)}, {draws.digits(4)}, '@', {draws.pick(dim.MAIL_DOMAINS)})"


def amount(draws: Draws, low: int, high: int) -> str:
    """Uniform, rounded to thousands."""
    return f"round({low} + {draws.unit()} * {high - low}, -3)"


def _today(as_of: dt.date | None) -> str:
    return f"date'{as_of.isoformat()}'" if as_of else "current_date()"


PLACEHOLDERS = {
    "phone_number": phone_number,
    "national_id": national_id,
    "full_name": full_name,
    "email": email,
    "bank_account": bank_account,
    "tax_id": tax_id,
    "emergency_name": full_name,
}
NOTE_KEYS = ["phone_number", "national_id", "full_name", "email", "bank_account"]
TX_KEYS = NOTE_KEYS + ["tax_id"]
HR_KEYS = ["phone_number", "national_id", "email", "bank_account", "tax_id", "emergency_name"]


def number_repeats(text: str) -> str:
    """Tell repeated placeholders apart, since each gets a value of its own."""
    seen: dict[str, int] = {}

    def mark(found: re.Match) -> str:
        key = found.group(1)
        seen[key] = seen.get(key, 0) + 1
        return "${" + key + (f"#{seen[key]}" if seen[key] > 1 else "") + "}"

    return re.sub(r"\$\{(\w+)\}", mark, text)


class Template:
    """Renders ``<name>_text``, a template joined to the rows, into ``name``.

    Only placeholders of the given keys, in texts that contain PII, are filled;
    a value is drawn only in rows whose text holds its placeholder.
    """

    def __init__(self, name: str, texts: list[str], keys: list[str], draws: Draws) -> None:
        self.name = name
        self.texts = [number_repeats(t) for t in texts]
        marks = sorted({m for t in self.texts for m in re.findall(r"\$\{\w+(?:#\d+)?\}", t)})
        self._values = {}
        for mark in marks:
            key = mark[2:-1].split("#")[0]
            if key in keys:
                self._values[mark] = PLACEHOLDERS[key](draws)

    def values(self) -> list[str]:
        """One expression per placeholder: its value, or NULL where the text lacks it."""
        text, wanted = f"{self.name}_text", f"{self.name}_pii"
        return [
            f"case when {wanted} and contains({text}, {string(mark)}) then {value} end as {self.name}_{i}"
            for i, (mark, value) in enumerate(self._values.items())
        ]

    def rendered(self) -> str:
        text = f"{self.name}_text"
        for i, mark in enumerate(self._values):
            text = f"replace({text}, {string(mark)}, coalesce({self.name}_{i}, {string(mark)}))"
        return text

    def join(self, rows: DataFrame, pool: DataFrame, index: str) -> DataFrame:
        """``rows`` with the picked template's text and flag; the pool is of fixed size."""
        named = pool.withColumnsRenamed(
            {"template_text": f"{self.name}_text", "contain_pii": f"{self.name}_pii"}
        )
        return rows.withColumn("template_index", F.expr(index)).join(F.broadcast(named), "template_index", "left")

    def apply(self, rows: DataFrame, pool: DataFrame, index: str) -> DataFrame:
        """``rows`` with the rendered text as ``name``."""
        joined = self.join(rows, pool, index)
        filled = joined.selectExpr("*", *self.values()).withColumn(self.name, F.expr(self.rendered()))
        return filled.drop("template_index", f"{self.name}_text", f"{self.name}_pii", *self._drawn())

    def _drawn(self) -> list[str]:
        return [f"{self.name}_{i}" for i in range(len(self._values))]


def _columns(ids: DataFrame, draws: Draws, seed: int, table: str, columns: dict[str, str]) -> DataFrame:
    """The ids with their digests and ``columns``. Templates come after, each with a
    projection of its own behind its join: small ones stay compilable for the JVM."""
    return draws.attach(ids, seed, table).selectExpr("*", *[f"{e} as {n}" for n, e in columns.items()])


def citizen_info(ids: DataFrame, seed: int, as_of: dt.date | None) -> DataFrame:
    draws, today, (low, high) = Draws(), _today(as_of), AGE_RANGE
    youngest = f"add_months({today}, {-12 * low})"
    span = f"datediff({youngest}, add_months({today}, {-12 * high}))"
    columns = {
        "full_name": full_name(draws),
        "national_id": national_id(draws),
        "phone_number": phone_number(draws),
        "email": email(draws),
        "birth_date": f"date_sub({youngest}, cast(floor({draws.unit()} * {span}) as int))",
        "occupation": draws.pick(dim.JOBS),
    }
    ward, house, street = draws.below(dim.WARD_COUNT), draws.below(999), draws.pick(dim.STREETS)
    columns["citizen_id"] = f"{ROW_ID} + 1"
    columns["ward_index"] = ward
    columns["street_line"] = f"concat(cast({house} + 1 as string), ' ', {street})"
    rows = _columns(ids, draws, seed, "citizen_info", columns)
    placed = rows.join(F.broadcast(dim.address_pool(ids.sparkSession)), "ward_index")
    return placed.withColumn("address", F.concat_ws(", ", "street_line", "ward_name", "province_name"))


def administrative_record(ids: DataFrame, seed: int, as_of: dt.date | None) -> DataFrame:
    """The template decides service, status and note together."""
    draws = Draws()
    index = draws.below(len(dim.CLERK_NOTES))
    columns = {
        "applicant_name": full_name(draws),
        "cccd_number": national_id(draws),
        "submission_date": f"date_sub({_today(as_of)}, cast({draws.below(HISTORY_DAYS + 1)} as int))",
    }
    note = Template("clerk_notes", dim.CLERK_NOTES, NOTE_KEYS, draws)
    columns["record_id"] = f"{ROW_ID} + 1"
    rows = _columns(ids, draws, seed, "administrative_record", columns)
    return note.apply(rows, dim.note_pool(ids.sparkSession, note.texts), index)


def transaction_log(ids: DataFrame, seed: int, as_of: dt.date | None) -> DataFrame:
    draws, spark = Draws(), ids.sparkSession
    message_index, fraud_index = draws.below(len(dim.TX_MESSAGES)), draws.below(len(dim.FRAUD_NOTES))
    suspicious = f"{draws.unit()} <= {FRAUD_NOTE_PROBABILITY}D"
    seconds = draws.below(HISTORY_DAYS * 86400)
    columns = {
        "tx_timestamp": f"cast({_today(as_of)} as timestamp) - make_dt_interval(0, 0, 0, {seconds})",
        "tx_type": draws.pick(dim.TX_TYPES),
        "amount": amount(draws, *AMOUNT_RANGE),
        "source_account": bank_account(draws),
        "target_account": bank_account(draws),
        "tax_id": tax_id(draws),
        "customer_name": full_name(draws),
    }
    message = Template("tx_message", dim.TX_MESSAGES, TX_KEYS, draws)
    fraud = Template("fraud_notes", dim.FRAUD_NOTES, TX_KEYS, draws)
    columns["tx_id"] = f"{ROW_ID} + 1"
    rows = _columns(ids, draws, seed, "transaction_log", columns)
    rows = message.apply(rows, dim.texts_frame(spark, message.texts), message_index)
    # No index, and so no text and no draws, for the many rows without a fraud note.
    return fraud.apply(rows, dim.texts_frame(spark, fraud.texts), f"case when {suspicious} then {fraud_index} end")


def hr_employee(ids: DataFrame, seed: int, as_of: dt.date | None) -> DataFrame:
    """c01-c05 hold name, salary, account, tax code and emergency phone."""
    draws = Draws()
    index = draws.below(len(dim.HR_REMARKS))
    columns = {
        "department": draws.pick(dim.DEPARTMENTS),
        "job_title": draws.pick(dim.JOBS),
        "c01": full_name(draws),
        "c02": amount(draws, *SALARY_RANGE),
        "c03": bank_account(draws),
        "c04": tax_id(draws, HR_TAX_ID_PLAIN),
        "c05": phone_number(draws),
    }
    remark = Template("remarks", dim.HR_REMARKS, HR_KEYS, draws)
    columns["employee_id"] = f"{ROW_ID} + 1"
    rows = _columns(ids, draws, seed, "hr_employee", columns)
    return remark.apply(rows, dim.texts_frame(ids.sparkSession, remark.texts), index)


GENERATORS = {
    "citizen_info": citizen_info,
    "administrative_record": administrative_record,
    "transaction_log": transaction_log,
    "hr_employee": hr_employee,
}


def generate_for(ids: DataFrame, table: str, seed: int = DEFAULT_SEED, as_of: dt.date | None = None) -> DataFrame:
    """One row of ``table`` per row of ``ids`` (a single bigint column of 0-based ids)."""
    if table not in GENERATORS:
        raise ValueError(f"no generator for {table!r}, only for {', '.join(sorted(GENERATORS))}")
    rows = GENERATORS[table](ids.toDF(ROW_ID), seed, as_of)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields])


def generate(
    spark: SparkSession, table: str, n: int = 100, seed: int = DEFAULT_SEED, as_of: dt.date | None = None
) -> DataFrame:
    """``n`` rows of ``table``; ``as_of`` stands in for today."""
    return generate_for(spark.range(n), table, seed, as_of)
