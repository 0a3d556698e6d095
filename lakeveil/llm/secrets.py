"""Secret scans with multipart credential linking, in built-in functions only.

Base findings stand alone: assignments, access identifiers, hexadecimal runs. Other parts are too common to
report by themselves: assigned passwords that no base kind takes, mixed random strings, account names and endpoints. Parts are
intervals of code points in their document, and a weak part is reported only if a complementary part lies in its
scope, i.e. within ``SCOPE`` code points: a secret next to an identifier or an endpoint, and the reverse.
The interval join is an equi-join on (document, bin) with bins as wide as the scope, so the rows that meet are bounded by
the width of a bin and not by the length of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeveil.llm.common import ROW, landed, located, text_of
from lakeveil.sources.workspace import stored

SCOPE = 300
_ASSIGN = r"""["']?\x20*[:=]\x20*["']?"""
# The base kinds in their order, each with its pattern, the group whose length counts, and that length.
BASE = {
    "assign": (rf"((?i:password|passwd|secret|token|api_?key)){_ASSIGN}([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
# Parts that count only in company; kind -> (pattern, group, least length, what it is).
WEAK = {
    "short_secret": (
        rf"((?i:password|passwd|pwd|passphrase|secret|token|api_?key|private_?key)){_ASSIGN}([^\x20\x09-\x0D\"',;]+)",
        2, 4, "secret",
    ),
    "random_secret": (
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{30,}+",
        0, 30, "secret",
    ),
    "account": (
        rf"((?i:access_?key_?id|client_?id|user_?name|user|login|account))(?<![A-Za-z]{{20}}){_ASSIGN}([A-Za-z0-9+/_.@-]+)",
        2, 3, "identifier",
    ),
    "endpoint": (
        r"(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\x20\x09-\x0D\"'<>]+"
        r"|(?i:host|hostname|endpoint|server)\x20*[:=]\x20*[\"']?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0, 6, "endpoint",
    ),
}
_ROLE = {"assign": "secret", "hex": "secret", "access": "identifier"} | {k: v[3] for k, v in WEAK.items()}
_ORDER = {kind: i for i, kind in enumerate(list(BASE) + list(WEAK))}


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Leftmost matches of a kind, not overlapping: what lies before each, how long it is, how long its group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    valued = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # Texts between matches; only their lengths go on.
    before = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    matches = F.arrays_zip(
        F.slice(before, 1, F.size(whole)).alias("before"),
        F.transform(whole, lambda m: F.length(m)).alias("length"),
        F.transform(valued, lambda m: F.length(m)).alias("valued"),
    )
    none = F.array().cast("array<struct<before:int,length:int,valued:int>>")
    return F.struct(
        F.lit(kind).alias("kind"), F.when(F.regexp_like(text, F.lit(pattern)), matches).otherwise(none).alias("matches")
    )


def parts_of(docs: DataFrame) -> DataFrame:
    """(locator, kind, start, end) of the base findings and of the weak parts, in code points, end exclusive."""
    least = F.create_map(*[F.lit(x) for k, v in (BASE | WEAK).items() for x in (k, v[2])])
    patterns = {k: v[:2] for k, v in (BASE | WEAK).items()}
    kinds = F.array(*[_found(F.col("body"), k, *p) for k, p in patterns.items()])
    rows = located(docs, text_of().alias("body")).select(*ROW, F.explode(kinds).alias("k"))
    rows = rows.where(F.size("k.matches") > 0).select(*ROW, "k.kind", F.posexplode("k.matches").alias("i", "m"))
    through = Window.partitionBy(*ROW, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.before") + F.col("m.length")).over(through)
    rows = rows.select(*ROW, "kind", (end - F.col("m.length")).alias("start"), end.alias("end"), "m.valued")
    rows = rows.where(F.col("valued") >= least[F.col("kind")])
    return rows.select(*ROW, "kind", "start", "end")


def _near(weak: DataFrame, others: DataFrame, scope: int, bins: int | None = None) -> DataFrame:
    """Rows of ``weak`` with some row of ``others`` at most ``scope`` code points away; with -1, those that overlap one.
    ``bins`` is their width, if not the scope."""
    width, gap = F.lit(bins or scope), F.lit(scope)
    reach = F.sequence(F.floor((F.col("start") - gap - 1) / width), F.floor((F.col("end") + gap) / width))
    left = weak.withColumn("bin", F.explode(reach))
    spread = F.explode(F.sequence(F.floor(F.col("o_start") / width), F.floor((F.col("o_end") - 1) / width)))
    right = others.select(*ROW, F.col("start").alias("o_start"), F.col("end").alias("o_end")).withColumn("bin", spread)
    l, r = left.alias("l"), right.alias("r").hint("merge")
    met = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in (*ROW, "bin")]
    close = (F.col("o_start") - F.col("end") <= gap) & (F.col("start") - F.col("o_end") <= gap)
    found = l.join(r, [*met, close], "left_semi")
    return found.select("l.*").drop("bin").distinct()


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that are reported."""
    role = F.create_map(*[F.lit(x) for k, v in _ROLE.items() for x in (k, v)])
    rows = parts.withColumn("role", role[F.col("kind")])
    # A weak part that overlaps a base finding is that finding again; one that only touches it is not.
    weak = rows.where(F.col("kind").isin(*WEAK))
    base = rows.where(F.col("kind").isin(*BASE))
    again = _near(weak, base, scope=-1, bins=SCOPE).select(*ROW, "kind", "start", "end")
    weak = weak.join(again.hint("merge"), [*ROW, "kind", "start", "end"], "left_anti").select(*rows.columns)
    fresh = stored(weak.union(base), "credential-parts")
    secrets, others = fresh.where("role = 'secret'"), fresh.where("role <> 'secret'")
    found = _near(secrets, others, scope).union(_near(others, secrets, scope))
    return found.where(F.col("kind").isin(*WEAK)).select(*ROW, "kind", "start", "end")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(locator, doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked), one row per row of ``docs``.

    ``spans`` lists kind:start:end by start, then kind as listed here, joined by commas; base_sha256 is of
    the base findings alone. Null and empty texts have none and give an empty list. Repeated rows give repeated results,
    an empty table none. Only doc_id and text are read, whole.
    """
    docs = landed(docs)
    parts = stored(parts_of(docs), "secret-parts")
    base = parts.where(F.col("kind").isin(*BASE))
    order = F.create_map(*[F.lit(x) for k, i in _ORDER.items() for x in (k, i)])
    both = base.union(linked_parts(parts, scope))
    both = both.withColumn("place", order[F.col("kind")])
    ordered = F.sort_array(F.collect_list(F.struct("start", "place", "end", "kind"))).alias("found")
    found = both.groupBy(*ROW).agg(ordered)
    rows = located(docs, "doc_id").join(found.hint("merge"), ROW, "left")
    empty = F.array().cast(found.schema["found"].dataType)
    rows = rows.withColumn("found", F.coalesce("found", empty))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    only_base = F.filter("found", lambda s: s["place"] < len(BASE))
    return rows.select(
        *ROW,
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(only_base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["place"] >= len(BASE))).cast("long").alias("n_linked"),
    )
