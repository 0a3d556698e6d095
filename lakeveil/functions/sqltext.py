"""Quoting for expressions that are written as SQL text."""

from __future__ import annotations


def identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def string(value: str | None) -> str:
    if value is None:
        return "cast(null as string)"
    quoted = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if "${" not in quoted:
        return quoted
    # Spark would substitute a configuration value for ${name}.
    return "concat(" + quoted.replace("${", "$', '{") + ")"


def pick(values: list[str], index: str) -> str:
    """The element of a literal list at a 0-based index that is never NULL."""
    return f"element_at(array({', '.join(string(v) for v in values)}), cast({index} as int) + 1)"


def pick_by_column(values: list[str], column: str) -> str:
    """The same for a column that may be NULL, which gives NULL."""
    branches = " ".join(f"when {i} then {string(v)}" for i, v in enumerate(values))
    return f"case {column} {branches} end"
