"""Which category of personal data a column holds, from its name and samples.

The rules are few (one per category), so they are compiled into expressions:
name matching is one CASE, pattern matching one aggregate per rule with a
literal pattern. There is no join between columns and rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeveil.functions.names import alias_contains_sql, alias_exact_sql, normalize_name
from lakeveil.functions.sqltext import identifier, pick_by_column, string
from lakeveil.operators.profile import samples_as_arrays
from lakeveil.plans.seeds import RULES, Rule

# Scores and weights of the detectors.
EXACT_CONFIDENCE = 1.0
CONTAINS_CONFIDENCE = 0.7
CONFIDENCE_THRESHOLD = 0.7
REGEX_WEIGHT = 0.8
NAME_WEIGHT = 0.2

COLUMN_KEY = ["table_name", "column_name"]


def _numbered(rules: list[Rule]) -> list[tuple[int, Rule]]:
    return list(enumerate(rules))


def match_names(frame: DataFrame, rules: list[Rule] = RULES, priority: str = "first") -> DataFrame:
    """Add name_category, name_confidence and name_sensitivity for ``column_name``.

    ``priority="first"``: the first rule that matches at all wins, even by a
    contained alias over a later rule's exact one. ``priority="best"``: any
    exact match beats every contained one.
    """
    if priority not in ("first", "best"):
        raise ValueError(f"unknown priority {priority!r}")
    # A hit is twice the rule's index, plus one if the alias was only contained.
    exact = [f"when {alias_exact_sql('normalized', r.aliases)} then {2 * i}" for i, r in _numbered(rules)]
    contained = [f"when {alias_contains_sql('normalized', r.aliases)} then {2 * i + 1}" for i, r in _numbered(rules)]
    branches = exact + contained if priority == "best" else [b for pair in zip(exact, contained) for b in pair]
    # Most names meet no alias at all, and one search tells.
    any_alias = alias_contains_sql("normalized", [a for r in rules for a in r.aliases])
    return (
        frame.withColumn("normalized", normalize_name(F.col("column_name")))
        .withColumn("hit", F.expr(f"case when not ({any_alias}) then null {' '.join(branches)} end"))
        .withColumn("rule", F.expr("hit div 2"))
        .selectExpr(
            *frame.columns,
            f"{pick_by_column([r.code for r in rules], 'rule')} as name_category",
            f"case hit % 2 when 0 then {EXACT_CONFIDENCE}D when 1 then {CONTAINS_CONFIDENCE}D end as name_confidence",
            f"{pick_by_column([r.sensitivity for r in rules], 'rule')} as name_sensitivity",
        )
    )


def _pattern(rule: Rule, match_mode: str) -> str:
    if match_mode not in ("search", "anchored"):
        raise ValueError(f"unknown match mode {match_mode!r}")
    return rule.pattern if match_mode == "search" else rf"\A(?:{rule.pattern})\z"


def _necessary_sql(value: str, pattern: str) -> str | None:
    """A cheap condition that holds wherever ``pattern`` is found, if one is plain to see.

    Long texts without an @, or without enough digits in a row, are spared the
    backtracking of the full pattern.
    """
    unclassed = re.sub(r"\[[^\]]*\]", "C", pattern)
    if re.search(r"(?<!\\)@(?![?*{])", unclassed) and not re.search(r"[|()]", unclassed):
        return f"contains({value}, '@')"
    ungrouped = re.sub(r"\([^()]*\)[?*]?", "", pattern)
    run = re.search(r"\[0-9\]\{(\d+)", ungrouped)
    if run and "(" in pattern and not re.search(r"[|()]", ungrouped):
        return f"{value} rlike '[0-9]{{{run.group(1)}}}'"
    return None


def found_sql(value: str, pattern: str) -> str:
    """True where ``pattern`` is found in ``value``."""
    search = f"{value} rlike {string(pattern)}"
    necessary = _necessary_sql(value, pattern)
    return f"{necessary} and {search}" if necessary else search


def ratio_column(rule: Rule) -> str:
    return f"ratio_{rule.code.lower()}"


def regex_ratios(
    values: DataFrame,
    keys: list[str],
    value: str,
    rules: list[Rule] = RULES,
    match_mode: str = "search",
) -> DataFrame:
    """Share of non-NULL values that each rule's pattern is found in, per key.

    Partial averages leave the map side, so a key with most of the rows costs
    no more to shuffle than any other.
    """
    aggregates = [
        F.expr(f"avg(cast({found_sql(identifier(value), _pattern(r, match_mode))} as double))").alias(ratio_column(r))
        for r in rules
        if r.pattern
    ]
    return values.where(F.col(value).isNotNull()).groupBy(*keys).agg(*aggregates)


def match_patterns(ratios: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Replace the ratio columns by regex_category, regex_confidence and regex_sensitivity.

    The highest ratio wins, the earlier rule on a tie; all are NULL if nothing matched.
    """
    with_pattern = [r for r in rules if r.pattern]
    names = [ratio_column(r) for r in with_pattern]
    kept = [c for c in ratios.columns if c not in names]
    best = ", ".join(["0.0D"] + [f"coalesce({n}, 0.0D)" for n in names])
    branches = "".join(f" when {n} = best then {i}" for i, n in enumerate(names))
    return (
        ratios.withColumn("best", F.expr(f"greatest(0.0D, {best})"))
        .withColumn("hit", F.expr(f"case when best = 0.0D then cast(null as int){branches} end"))
        .selectExpr(
            *kept,
            f"{pick_by_column([r.code for r in with_pattern], 'hit')} as regex_category",
            "case when hit is not null then best end as regex_confidence",
            f"{pick_by_column([r.sensitivity for r in with_pattern], 'hit')} as regex_sensitivity",
        )
    )


_EVIDENCE = [f"{source}_{part}" for source in ("name", "regex") for part in ("category", "confidence", "sensitivity")]


def combine(evidence: DataFrame) -> DataFrame:
    """Merge name and pattern evidence into category, confidence, detection_method, sensitivity.

    Agreement weighs both, disagreement takes the pattern's side; no threshold yet.
    """
    kept = [c for c in evidence.columns if c not in _EVIDENCE]
    weighted = f"{REGEX_WEIGHT}D * regex_confidence + {NAME_WEIGHT}D * name_confidence"
    return evidence.selectExpr(
        *kept,
        "coalesce(regex_category, name_category) as category",
        "case when regex_category is null then coalesce(name_confidence, 0.0D)"
        f" when regex_category = name_category then {weighted} else regex_confidence end as confidence",
        "case when regex_category is null and name_category is null then 'UNKNOWN'"
        " when regex_category is null then 'MANUAL'"
        " when regex_category = name_category then 'HYBRID' else 'REGEX' end as detection_method",
        "case when regex_category is null then name_sensitivity else regex_sensitivity end as sensitivity",
    )


def apply_threshold(combined: DataFrame) -> DataFrame:
    """Below the threshold only the confidence is kept and the method is UNKNOWN."""
    sure = f"confidence >= {CONFIDENCE_THRESHOLD}D"
    replaced = {
        "category": f"case when {sure} then category end",
        "detection_method": f"case when {sure} then detection_method else 'UNKNOWN' end",
        "sensitivity": f"case when {sure} then sensitivity end",
    }
    return combined.selectExpr(*[f"{replaced[c]} as {c}" if c in replaced else c for c in combined.columns])


def detect(
    columns: DataFrame,
    samples: DataFrame,
    rules: list[Rule] = RULES,
    match_mode: str = "search",
    priority: str = "first",
) -> DataFrame:
    """``columns`` with the evidence of both detectors.

    ``columns`` has (table_name, column_name, ...); ``samples`` is the output of
    ``sample_tables``. Columns without samples have no pattern evidence.
    """
    ratios = regex_ratios(samples, COLUMN_KEY, "sample_value", rules, match_mode)
    return match_names(columns, rules, priority).join(match_patterns(ratios, rules), COLUMN_KEY, "left")


def classify(
    columns: DataFrame,
    samples: DataFrame,
    rules: list[Rule] = RULES,
    match_mode: str = "search",
    priority: str = "first",
    with_samples: bool = False,
) -> DataFrame:
    """``columns`` plus category, confidence, detection_method and sensitivity."""
    classified = apply_threshold(combine(detect(columns, samples, rules, match_mode, priority)))
    if with_samples:
        classified = classified.join(samples_as_arrays(samples), COLUMN_KEY, "left")
    return classified
