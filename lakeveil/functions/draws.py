"""Seeded pseudo-random draws: pure functions of (seed, table, row id).

A retried task draws the same values again, and a row keeps its values
however the rows are partitioned. A row has a few MD5 digests; every draw reads
its own part of one of them, so a row costs a few digests and not one per draw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeveil.functions.sqltext import pick, string

ROW_ID = "row_id"
_PART_DIGITS = 8
_PARTS_PER_DIGEST = 4


class Draws:
    """Hands out the parts of a row's digests, in order of asking."""

    def __init__(self) -> None:
        self._parts = 0

    def number(self, digits: int = _PART_DIGITS) -> str:
        """A whole number from ``digits`` hex digits (at most 14)."""
        parts = 1 if digits <= _PART_DIGITS else 2
        left = _PARTS_PER_DIGEST - self._parts % _PARTS_PER_DIGEST
        if parts > left:
            self._parts += left
        digest, part = divmod(self._parts, _PARTS_PER_DIGEST)
        self._parts += parts
        return f"cast(conv(substring(digest_{digest}, {part * _PART_DIGITS + 1}, {digits}), 16, 10) as bigint)"

    def below(self, bound: int) -> str:
        """Whole number in ``[0, bound)``."""
        return f"({self.number()} % {bound})"

    def unit(self) -> str:
        """Double in ``[0, 1)``."""
        return f"({self.number()} / {16**_PART_DIGITS}D)"

    def digits(self, width: int) -> str:
        """``width`` decimal digits (at most 14), leading zeros kept."""
        if not 1 <= width <= 14:
            raise ValueError("width must be between 1 and 14")
        return f"lpad(cast({self.number(14)} % {10**width} as string), {width}, '0')"

    def pick(self, values: list[str]) -> str:
        """Uniform choice from a short list."""
        return pick(values, self.below(len(values)))

    def attach(self, rows: DataFrame, seed: int, table: str) -> DataFrame:
        """``rows`` with the digests that the draws asked for so far read."""
        count = -(-self._parts // _PARTS_PER_DIGEST)
        digests = [
            f"md5(concat({string(f'{seed}|{table}|{i}|')}, cast({ROW_ID} as string))) as digest_{i}"
            for i in range(count)
        ]
        return rows.selectExpr("*", *digests)
