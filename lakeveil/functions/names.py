"""Column-name normalisation and alias matching as expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeveil.functions.sqltext import string


def normalize_name(name: Column) -> Column:
    """Lower-case, then drop everything outside ``[a-z0-9]`` (diacritics too)."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def alias_exact_sql(normalized: str, aliases: list[str]) -> str:
    """True where the normalized name is one of the aliases."""
    return f"{normalized} in ({', '.join(map(string, aliases))})" if aliases else "false"


def alias_contains_sql(normalized: str, aliases: list[str]) -> str:
    """True where the normalized name contains any of the aliases.

    One alternation instead of a search per alias. An alias with a character
    that normalisation removes cannot occur in a normalized name.
    """
    possible = [a for a in aliases if re.fullmatch("[a-z0-9]*", a)]
    return f"{normalized} rlike {string('|'.join(possible))}" if possible else "false"
