"""DuckDB SQL of the queries that have longer ones; it shares no code with the operators."""

from __future__ import annotations

_TRIMMED = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_ORACLE = f"""with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from split),
keyed as (select *, {_LOWER.format(_TRIMMED)} as key from lines),
shared as (select key, min(doc_id) as keep_id from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
judged as (select doc_id, line, place, keep_id is not null and keep_id <> doc_id as dropped
  from keyed left join shared using (key))
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from judged group by doc_id"""

# Levels of eight that the SQL unrolls; enough for 8^7 rows of one language.
_LEVELS = 7


def _leaf(text: str) -> str:
    parts = ["doc_id", "source", "lang", "n_chars", text]
    sized = [f"coalesce(strlen({p}::varchar)::varchar || ':' || {p}::varchar, '-')" for p in parts]
    return f"sha256({' || '.join(sized)})"


def _climb(prefix: str, first: str, keys: str) -> list[str]:
    """CTEs {prefix}0.. of (keys, place, n, h): each level from the one below, unless one node is left."""
    ctes = [f"{prefix}0 as ({first})"]
    for k in range(_LEVELS):
        ctes.append(
            f"{prefix}{k + 1} as (select {keys}, place // 8 as place, (n + 7) // 8 as n,"
            f" case when n > 1 then sha256(string_agg(h, '' order by place)) else min(h) end as h"
            f" from {prefix}{k} group by {keys}, place // 8, n)"
        )
    return ctes


def _siblings(prefix: str, keys: str) -> list[str]:
    """CTEs {prefix}s0.. of (keys, place, l, r): what stands left and right of each node in its run."""
    ctes = []
    for k in range(_LEVELS):
        window = f"partition by {keys}, place // 8 order by place rows between"
        ctes.append(
            f"{prefix}s{k} as (select {keys}, place, coalesce(string_agg(h, '') over ({window} unbounded preceding and 1 preceding), '') as l,"
            f" coalesce(string_agg(h, '') over ({window} 1 following and unbounded following), '') as r, n from {prefix}{k})"
        )
    return ctes


def manifest_oracle() -> str:
    """Leaves, both trees unrolled level by level, and every row folded through them."""
    # The check sum of the digits, bit by bit: -1 stands for one shift.
    steps = "flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "case when b >= 0 then xor(a, b) else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end"
    crc = f"xor(list_reduce({steps}, lambda a, b: {step}, 4294967295::bigint), 4294967295)"
    ctes = [
        f"base as (select doc_id, coalesce('+' || lang, '') as tree, {_leaf('text')} as leaf,"
        f" case when ({crc}) % 3 = 0 then {_leaf(_LOWER.format('text'))} else {_leaf('text')} end as claimed from documents)",
        "numbered as (select *, row_number() over (partition by tree order by doc_id) - 1 as place from base)",
        *_climb("t", "select tree, place, count(*) over (partition by tree) as n, leaf as h from numbered", "tree"),
        *_siblings("t", "tree"),
        f"subs as (select tree, h as subroot, row_number() over (order by tree::blob) - 1 as place from t{_LEVELS})",
        *_climb("u", "select 0 as one, place, count(*) over () as n, subroot as h from subs", "one"),
        *_siblings("u", "one"),
        f"fold0 as (select doc_id, tree, leaf, place, claimed as h, '' as proof from numbered)",
    ]
    last = "fold0"
    for k in range(2 * _LEVELS):
        level, prefix = k % _LEVELS, "tu"[k // _LEVELS]
        if k == _LEVELS:
            ctes.append(f"across as (select f.* replace (s.place as place) from {last} f join subs s using (tree))")
            last = "across"
        key = "s.tree = f.tree" if prefix == "t" else "true"
        ctes.append(
            f"fold{k + 1} as (select doc_id, f.tree, leaf, f.place // 8 as place,"
            f" case when n > 1 then sha256(l || f.h || r) else f.h end as h, case when n > 1 then proof || l || r else proof end as proof"
            f" from {last} f join {prefix}s{level} s on {key} and s.place = f.place)"
        )
        last = f"fold{k + 1}"
    return (
        f"with {', '.join(ctes)} select doc_id, leaf, subroot, u{_LEVELS}.h as root, sha256(proof) as proof_sha256,"
        f" {last}.h as folded_root, {last}.h = u{_LEVELS}.h as verified from {last} join subs using (tree), u{_LEVELS}"
    )
