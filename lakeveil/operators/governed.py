"""Applying an access plan to a table: one projection of mask expressions.

Filters that a caller adds later see masked values only. On an allowed column
they still reach the scan; on a masked one they stay above the mask, because a
filter on the raw value would reveal it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeveil.functions.masks import mask_column, mask_sql
from lakeveil.functions.sqltext import identifier
from lakeveil.operators.profile import quoted

_SPREAD = "lakeveil_spread"


@dataclass(frozen=True)
class ColumnAction:
    column_name: str
    action: str = "ALLOW"
    masking_function: str | None = None
    category: str | None = None


def collect_actions(plan: DataFrame) -> dict[str, ColumnAction]:
    """The plan of one role and one table as plan-time values; one row per column."""
    rows = plan.select("column_name", "action", "masking_function", "category").collect()
    return {r.column_name: ColumnAction(*r) for r in rows}


def visible(
    names: list[str],
    actions: dict[str, ColumnAction],
    columns: list[str] | None = None,
    unknown: str = "allow",
) -> list[ColumnAction]:
    """What is shown of a table with the columns ``names``, in order; see ``govern``."""
    if unknown not in ("allow", "deny"):
        raise ValueError(f"unknown must be 'allow' or 'deny', not {unknown!r}")
    if columns is not None:
        for name in columns:
            action = actions.get(name)
            if action is None or action.action == "DENY":
                raise ValueError(f"no readable column {name!r}: it is missing, or the role may not see it")
    fallback = "ALLOW" if unknown == "allow" else "DENY"
    shown = [actions.get(n) or ColumnAction(n, fallback) for n in (columns if columns is not None else names)]
    return [a for a in shown if a.action != "DENY"]


def govern(
    df: DataFrame,
    actions: dict[str, ColumnAction],
    columns: list[str] | None = None,
    unknown: str = "allow",
) -> DataFrame:
    """``df`` as the plan lets it be seen. Works on streams too: it is stateless.

    With ``columns``, denied and uncatalogued ones raise the same error. Without,
    denied columns are left out, and those the plan does not know pass
    (``unknown="allow"``) or are left out (``"deny"``).
    """
    selected = []
    for action in visible(df.columns, actions, columns, unknown):
        value = quoted(action.column_name)
        if action.action == "MASK":
            value = mask_column(value, action.masking_function, action.category).alias(action.column_name)
        selected.append(value)
    return df.select(*selected)


def action_sql(action: ColumnAction) -> str:
    """A visible column as SQL text, as ``govern`` shows it."""
    name = identifier(action.column_name)
    return f"{mask_sql(name, action.masking_function, action.category)} AS {name}" if action.action == "MASK" else name


def masked_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "inner") -> DataFrame:
    """Join two governed tables on hash-masked keys.

    Equal values have equal hashes, so the join holds without the raw keys. Columns of
    the two sides that share a name are told apart as ``l.name`` and ``r.name``. NULL keys
    never match: an inner join drops them, and an outer one deals those of the preserved
    sides out by a second key that no row of the other side has. The side is broadcast
    only if the optimizer's size estimate allows it; otherwise both are shuffled and
    adaptive execution splits a key that is hot on one side.
    """
    key_l, key_r = quoted(left_on), quoted(right_on)
    if how == "inner":
        left, right = left.where(key_l.isNotNull()), right.where(key_r.isNotNull())
        return left.alias("l").join(right.alias("r"), _of("l", left_on) == _of("r", right_on), how)
    spread = [F.when(k.isNull(), 1 + F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), 1024)).otherwise(0)
              for k, df in ((key_l, left), (key_r, right))]
    met = left.withColumn(_SPREAD, spread[0]).alias("l").join(
        right.withColumn(_SPREAD, spread[1]).alias("r"),
        (_of("l", left_on) == _of("r", right_on)) & (_of("l", _SPREAD) == _of("r", _SPREAD)),
        how,
    )
    return met.drop(_of("l", _SPREAD)).drop(_of("r", _SPREAD)) if how not in ("semi", "anti", "left_semi", "left_anti") else met.drop(_SPREAD)


def _of(side: str, name: str) -> Column:
    return F.col(f"{side}.`" + name.replace("`", "``") + "`")


def group_by_masked(df: DataFrame, key: str, **aggregates: str) -> DataFrame:
    """Aggregate per masked key; partial sums leave the map side."""
    return df.groupBy(quoted(key).alias(key)).agg(*[F.expr(e).alias(n) for n, e in aggregates.items()])
