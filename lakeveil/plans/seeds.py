"""Reference values of the governance model: levels, roles, rules, policies."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes of the governance model.
SENSITIVITY_LEVELS = ["HIGH", "MEDIUM", "LOW", "NONE"]
ROLES = ["ADMIN", "ANALYST", "AUDITOR"]
MASKING_FUNCTIONS = ["PARTIAL_MASK", "HASH_MASK", "REDACT", "NULLIFY"]
DETECTION_METHODS = ["REGEX", "LLM", "HYBRID", "MANUAL", "UNKNOWN"]
POLICY_ACTIONS = ["ALLOW", "MASK", "DENY"]


@dataclass(frozen=True)
class Rule:
    """How one category of personal data is recognised."""

    code: str
    pattern: str | None
    aliases: list[str] = field(default_factory=list)
    sensitivity: str = "NONE"


# Detection rules. Their order decides ties.
RULES = [
    Rule(
        "NATIONAL_ID",
        r"[0-9]{12}",
        ["cccd", "cmnd", "citizenid", "nationalid", "identitynumber", "personalid"],
        "HIGH",
    ),
    Rule(
        "BANK_ACCOUNT",
        r"[0-9]{8,20}",
        ["bankaccount", "accountnumber", "bankacc", "stk", "sotaikhoan"],
        "HIGH",
    ),
    Rule("TAX_CODE", r"[0-9]{10}(-[0-9]{3})?", ["taxcode", "taxid", "mst", "masothue"], "HIGH"),
    Rule(
        "SALARY",
        None,
        ["salary", "wage", "income", "monthlysalary", "annualsalary", "luong", "mucluong"],
        "HIGH",
    ),
    Rule(
        "PHONE",
        r"(03|05|07|08|09)[0-9]{8}",
        [
            "phone",
            "phonenumber",
            "mobile",
            "mobilephone",
            "telephone",
            "tel",
            "contactnumber",
            "sdt",
            "sodienthoai",
        ],
        "MEDIUM",
    ),
    Rule(
        "EMAIL",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
        ["email", "emailaddress", "mail"],
        "MEDIUM",
    ),
    Rule(
        "FULL_NAME",
        None,
        [
            "fullname",
            "name",
            "customername",
            "employeename",
            "citizenname",
            "personname",
            "hoten",
            "hovaten",
        ],
        "MEDIUM",
    ),
    Rule("ADDRESS", None, ["address", "homeaddress", "residentialaddress", "location", "diachi"], "LOW"),
    Rule("DATE_OF_BIRTH", None, ["dob", "birthdate", "birthday", "dateofbirth", "ngaysinh"], "LOW"),
    Rule(
        "WORKPLACE",
        None,
        [
            "workplace",
            "company",
            "companyname",
            "organization",
            "organizationname",
            "employer",
            "office",
            "worklocation",
        ],
        "LOW",
    ),
]

CATEGORY_CODES = [rule.code for rule in RULES]

# What each role may see at each level (action, masking function).
POLICIES = {
    "ADMIN": {
        "HIGH": ("ALLOW", None),
        "MEDIUM": ("ALLOW", None),
        "LOW": ("ALLOW", None),
        "NONE": ("ALLOW", None),
    },
    "ANALYST": {
        "HIGH": ("MASK", "HASH_MASK"),
        "MEDIUM": ("MASK", "PARTIAL_MASK"),
        "LOW": ("ALLOW", None),
        "NONE": ("ALLOW", None),
    },
    "AUDITOR": {
        "HIGH": ("MASK", "REDACT"),
        "MEDIUM": ("MASK", "REDACT"),
        "LOW": ("ALLOW", None),
        "NONE": ("ALLOW", None),
    },
}


def literal_frame(spark: SparkSession, columns: dict[str, list], schema: pa.Schema) -> DataFrame:
    """A small constant table. Arrow input becomes a LocalRelation, so the
    optimizer knows its exact size when it picks a join."""
    return spark.createDataFrame(pa.table(columns, schema=schema))


# Only so many unknown codes are named in warnings; all are left out.
_WARNED_CODES = 20


def codes_frame(spark: SparkSession, codes: list[str], name: str = "code") -> DataFrame:
    """(id, code) with ids from 1 in the given order."""
    schema = pa.schema([("id", pa.int32()), (name, pa.string())])
    return literal_frame(spark, {"id": list(range(1, len(codes) + 1)), name: codes}, schema)


def sensitivity_levels(spark: SparkSession) -> DataFrame:
    return codes_frame(spark, SENSITIVITY_LEVELS)


def roles(spark: SparkSession) -> DataFrame:
    return codes_frame(spark, ROLES, "role_name")


def masking_functions(spark: SparkSession) -> DataFrame:
    return codes_frame(spark, MASKING_FUNCTIONS, "function_name")


def pii_categories(spark: SparkSession, rules: list[Rule] = RULES) -> DataFrame:
    """(id, code, regex_pattern, column_name_aliases, default_sensitivity)."""
    schema = pa.schema(
        [
            ("id", pa.int32()),
            ("code", pa.string()),
            ("regex_pattern", pa.string()),
            ("column_name_aliases", pa.list_(pa.string())),
            ("default_sensitivity", pa.string()),
        ]
    )
    columns = {
        "id": list(range(1, len(rules) + 1)),
        "code": [r.code for r in rules],
        "regex_pattern": [r.pattern for r in rules],
        "column_name_aliases": [r.aliases for r in rules],
        "default_sensitivity": [r.sensitivity for r in rules],
    }
    return literal_frame(spark, columns, schema)


def access_policies(spark: SparkSession, policies: dict = POLICIES) -> DataFrame:
    """(role_name, sensitivity, action, masking_function), one row per pair."""
    rows = [
        (role, level, action, masking)
        for role, by_level in policies.items()
        for level, (action, masking) in by_level.items()
    ]
    names = ["role_name", "sensitivity", "action", "masking_function"]
    schema = pa.schema([(n, pa.string()) for n in names])
    return literal_frame(spark, {n: [r[i] for r in rows] for i, n in enumerate(names)}, schema)


def load_rules(categories: DataFrame) -> DataFrame:
    """Category rows as usable rules, in id order.

    Codes outside the known set are dropped, an unknown or missing level
    becomes NONE and missing aliases an empty array.
    """
    level = F.col("default_sensitivity")
    return (
        categories.where(F.col("code").isin(*CATEGORY_CODES))
        .select(
            F.col("id").alias("rule_order"),
            "code",
            "regex_pattern",
            F.when(level.isin(*SENSITIVITY_LEVELS), level).otherwise(F.lit("NONE")).alias("sensitivity"),
            F.coalesce("column_name_aliases", F.array().cast("array<string>")).alias("column_name_aliases"),
        )
    )


def collect_rules(categories: DataFrame) -> list[Rule]:
    """The rules as plan-time values. Codes must be unique, so there is at most one per known code."""
    rules = load_rules(categories)
    if not rules.groupBy("code").count().where("count > 1").isEmpty():
        raise ValueError("two rules share a category code")
    unknown = categories.where(~F.col("code").isin(*CATEGORY_CODES)).select("code").distinct()
    for row in unknown.orderBy("code").take(_WARNED_CODES):
        warnings.warn(f"no such category, rule left out: {row.code}", stacklevel=2)
    rows = rules.orderBy("rule_order").collect()
    return [Rule(r.code, r.regex_pattern, list(r.column_name_aliases), r.sensitivity) for r in rows]
