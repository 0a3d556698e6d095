"""Masks as Column expressions; all of them give a string and keep NULL as NULL.

No mask needs a Python worker: they stay inside whole-stage codegen and let
Catalyst prune the columns that a reader does not ask for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeveil.functions.sqltext import string

REDACTED = "[REDACTED]"
_ONE_ADDRESS = r"\A[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"

# What "." leaves alone in a Java pattern, besides the newline.
_RARE_BREAKS = ["\r", "\u0085", "\u2028", "\u2029"]


def _holds_any(text: Column, marks: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(mark)) for mark in marks])


def _text(value: Column | str) -> Column:
    column = F.col("`" + value.replace("`", "``") + "`") if isinstance(value, str) else value
    return column.cast("string")


def _mask_line(line: Column, replace_char: str) -> Column:
    replacement = replace_char.replace("\\", "\\\\").replace("$", "\\$")
    stars = F.repeat(F.lit(replace_char), F.length(line))
    return F.when(_holds_any(line, _RARE_BREAKS), F.regexp_replace(line, ".", replacement)).otherwise(stars)


def partial_mask(value: Column | str, replace_char: str = "*") -> Column:
    """First character, then ``replace_char`` for each later one; line breaks stay.

    Texts of many lines are masked line by line: replacing them character by
    character with a pattern took six times as long.
    """
    text = _text(value)
    rest = F.substring(text, 2, 2147483647)
    lines = F.transform(F.split(rest, "\n"), lambda line: _mask_line(line, replace_char))
    stars = F.repeat(F.lit(replace_char), F.length(rest))
    masked = F.when(_holds_any(rest, ["\n", *_RARE_BREAKS]), F.array_join(lines, "\n")).otherwise(stars)
    return F.concat(F.substring(text, 1, 1), masked)


def hash_mask(value: Column | str) -> Column:
    """SHA-256 hex of the text form; equal values keep equal masks."""
    return F.sha2(_text(value), 256)


def redact_mask(value: Column | str, redacted: str = REDACTED) -> Column:
    """A fixed word in place of every non-NULL value."""
    return F.when(_text(value).isNotNull(), F.lit(redacted))


def nullify_mask(value: Column | str | None = None) -> Column:
    """NULL, typed as string."""
    return F.lit(None).cast("string")


def _keep_ends(value: Column | str, head: int, tail: int, replace_char: str) -> Column:
    text = _text(value)
    kept = F.concat(
        F.substring(text, 1, head),
        F.repeat(F.lit(replace_char), F.length(text) - (head + tail)),
        F.right(text, F.lit(tail)),
    )
    # Shorter values would show themselves whole, so they take the default mask.
    return F.when(F.length(text) > head + tail, kept).otherwise(partial_mask(text, replace_char))


def phone_mask(value: Column | str, replace_char: str = "*") -> Column:
    """Keep the first three and the last two characters."""
    return _keep_ends(value, 3, 2, replace_char)


def national_id_mask(value: Column | str, replace_char: str = "*") -> Column:
    """Keep the first three and the last four characters."""
    return _keep_ends(value, 3, 4, replace_char)


def email_mask(value: Column | str, replace_char: str = "*") -> Column:
    """First character of the local part, ``***@``, then the domain.

    Anything but one whole address takes the default mask: what follows an @ in a
    longer text is not a domain.
    """
    text = _text(value)
    kept = F.concat(
        F.substring(F.substring_index(text, "@", 1), 1, 1),
        F.lit("***@"),
        F.substring_index(text, "@", -1),
    )
    return F.when(text.rlike(_ONE_ADDRESS), kept).otherwise(partial_mask(text, replace_char))


PARTIAL_BY_CATEGORY = {
    "EMAIL": email_mask,
    "PHONE": phone_mask,
    "NATIONAL_ID": national_id_mask,
}


def mask_column(
    value: Column | str,
    masking_function: str | None,
    category: str | None = None,
    replace_char: str = "*",
) -> Column:
    """Mask by function code; only the partial mask depends on the category.

    A missing or unknown function hides the value.
    """
    if masking_function == "PARTIAL_MASK":
        return PARTIAL_BY_CATEGORY.get(category, partial_mask)(value, replace_char)
    if masking_function == "HASH_MASK":
        return hash_mask(value)
    if masking_function == "REDACT":
        return redact_mask(value)
    return nullify_mask(value)


# The same masks as SQL text, for views. A view keeps its text, which Column expressions don't have.


def _holds_any_sql(text: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {string(mark)})" for mark in marks) + ")"


def _partial_sql(text: str) -> str:
    rest, breaks = f"substring({text}, 2)", string("\n")
    line = (
        f"CASE WHEN {_holds_any_sql('line', _RARE_BREAKS)} THEN regexp_replace(line, '.', '*')"
        " ELSE repeat('*', length(line)) END"
    )
    lines = f"array_join(transform(split({rest}, {breaks}), line -> {line}), {breaks})"
    masked = f"CASE WHEN {_holds_any_sql(rest, [chr(10), *_RARE_BREAKS])} THEN {lines} ELSE repeat('*', length({rest})) END"
    return f"concat(substring({text}, 1, 1), {masked})"


def _keep_ends_sql(text: str, head: int, tail: int) -> str:
    kept = f"concat(left({text}, {head}), repeat('*', length({text}) - {head + tail}), right({text}, {tail}))"
    return f"CASE WHEN length({text}) > {head + tail} THEN {kept} ELSE {_partial_sql(text)} END"


def _email_sql(text: str) -> str:
    kept = f"concat(left(substring_index({text}, '@', 1), 1), '***@', substring_index({text}, '@', -1))"
    return f"CASE WHEN {text} RLIKE {string(_ONE_ADDRESS)} THEN {kept} ELSE {_partial_sql(text)} END"


def mask_sql(value: str, masking_function: str | None, category: str | None = None) -> str:
    """``mask_column`` of the SQL expression ``value``."""
    text = f"cast({value} AS string)"
    if masking_function == "PARTIAL_MASK":
        by_category = {
            "EMAIL": _email_sql(text),
            "PHONE": _keep_ends_sql(text, 3, 2),
            "NATIONAL_ID": _keep_ends_sql(text, 3, 4),
        }
        return by_category.get(category) or _partial_sql(text)
    if masking_function == "HASH_MASK":
        return f"sha2({text}, 256)"
    if masking_function == "REDACT":
        return f"CASE WHEN {text} IS NOT NULL THEN {string(REDACTED)} END"
    return "cast(NULL AS string)"
