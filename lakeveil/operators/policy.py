"""What a role may do with each catalogued column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAN_COLUMNS = [
    "role_name",
    "namespace",
    "table_name",
    "column_name",
    "category",
    "sensitivity",
    "action",
    "masking_function",
]


def access_plan(columns: DataFrame, policies: DataFrame, roles: list[str]) -> DataFrame:
    """One row per role and column: ALLOW, MASK with a function, or DENY.

    A column without a level, or whose level has no policy, is allowed. The
    policies are unique per (role, level), so the join adds no rows.
    """
    fanned = columns.select(
        F.explode(F.array(*[F.lit(r) for r in roles])).alias("role_name"),
        "namespace",
        "table_name",
        "column_name",
        "category",
        "sensitivity",
    )
    return (
        fanned.join(policies, ["role_name", "sensitivity"], "left")
        .withColumn("action", F.coalesce("action", F.lit("ALLOW")))
        .select(*PLAN_COLUMNS)
    )


def policies_for_role(policies: DataFrame, roles: DataFrame, role: str) -> DataFrame:
    """The policies of one role; an unknown role is an error, not an empty answer."""
    if roles.where(F.col("role_name") == role).isEmpty():
        raise ValueError(f"no role named {role!r}")
    return policies.where(F.col("role_name") == role)


def access_policy_point(policies: DataFrame, role: str, sensitivity: str) -> DataFrame:
    """The policy of one (role, level) pair; no row if there is none."""
    return policies.where((F.col("role_name") == role) & (F.col("sensitivity") == sensitivity))


def plan_lookup(plan: DataFrame, table: str, column: str) -> DataFrame:
    """The plan's row for one column; no row if it is not catalogued."""
    return plan.where((F.col("table_name") == table) & (F.col("column_name") == column))
