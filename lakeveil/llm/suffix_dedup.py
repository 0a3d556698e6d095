"""Removal of long repeated byte strings, decided by suffix arrays.

A string of ``length`` bytes that starts at two places holds, at both, the same minimiser: of its k-byte strings the one
with the smallest hash, the leftmost of equals. So the strings fall into groups by their minimiser, and only minimisers that
occur twice matter. Around such a place the strings with that minimiser make up one context, a stretch of the document.
If all contexts of a minimiser are the same, all their strings repeat. Else the group's different contexts, each once,
are sorted: symbols are runs of bytes on which no two contexts of the group differ in part, and one suffix array over
many groups, by the linear grouping construction below, has repeated strings as neighbours with a long common prefix.

Equal texts are one text with a count from the start. A minimiser with more different contexts than one task should hold is
decided by counting its strings themselves, which needs no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import FILE, POS, ROW, landed, located
from lakeveil.llm.hashing import mixed, powers, prefix_hashes, slices
from lakeveil.sources.workspace import stored

LENGTH = 200
_SEED_BYTES = 64
_PLACES = 20  # bits of a place in a flat array
_FLAT = 1 << 19
MAX_GROUP = 20_000
_BATCH_SYMBOLS = 20_000


# ------------------------------------------------------------- suffix sorting


def suffix_array(text: list[int]) -> list[int]:
    """The starts of the suffixes of ``text`` in order, by Baier's grouping construction (2016).

    Suffixes are grouped by their Lyndon prefix, starting from their first symbol. Groups are final in descending order:
    each member of the highest open group is appended to the suffix its previous-smaller pointer leads to, which moves
    to a new group just above its old one, the higher the more members it got. A second pass goes through the order as it
    comes into being: each suffix puts those whose Lyndon prefix ends where it starts at the next free place of their group.
    """
    n = len(text)
    symbols = {s: g for g, s in enumerate(sorted(set(text)))}
    group = [symbols[s] for s in text]
    members: list[set[int]] = [set() for _ in symbols]
    for i, g in enumerate(group):
        members[g].add(i)
    width = [1] * len(symbols)
    below = list(range(-1, len(symbols) - 1))
    above = [*range(1, len(symbols)), -1]
    pointer = list(range(-1, n - 1))
    closed = bytearray(n)
    next_smaller = [0] * n
    descending = []
    now = len(symbols) - 1
    while now >= 0:
        mine, length = members[now], width[now]
        for i in mine:
            closed[i] = 1
            next_smaller[i] = i + length
        got: dict[int, int] = {}
        for i in mine:
            p = pointer[i]
            while p >= 0 and closed[p]:
                p = pointer[p]
            while pointer[i] != p:  # a shorter way for those that come later
                pointer[i], i = p, pointer[i]
            if p >= 0:
                got[p] = got.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in got.items():
            moved.setdefault((group[p], times), []).append(p)
        # Each new group goes right above the old one, so those with more come first.
        for old, times in sorted(moved, reverse=True):
            part, new = moved[old, times], len(members)
            if len(part) == len(members[old]):
                width[old] += times * length  # all that is left of it moves: it stays where it is
                continue
            members[old].difference_update(part)
            members.append(set(part))
            width.append(width[old] + times * length)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
            for p in part:
                group[p] = new
        descending.append(now)
        now = below[now]
    head, place = [0] * len(members), 0
    for g in reversed(descending):
        head[g] = place
        place += len(members[g])
    first, following = [-1] * (n + 1), [-1] * n
    for i, s in enumerate(next_smaller):
        following[i], first[s] = first[s], i
    order = [-1] * n
    for at in range(-1, n):
        i = first[n if at < 0 else order[at]]
        while i >= 0:
            g = group[i]
            order[head[g]] = i
            head[g] += 1
            i = following[i]
    return order


# --------------------------------------------------------------- minimisers


def minimisers(raw: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the text, hashes, places, first and last starts of the strings they stand for), part by part."""
    whole = []
    for number, text in enumerate(raw):
        for start in range(0, max(1, len(text) - length + 1), _FLAT - length):
            piece = text[start : start + _FLAT - 1]
            if len(piece) >= length:
                whole.append((number, start, piece))
    group: list[tuple[int, int, bytes]] = []
    total = 0
    for item in whole:
        if group and total + len(item[2]) > _FLAT:
            yield from _flat_minimisers(group, length)
            group, total = [], 0
        group.append(item)
        total += len(item[2])
    if group:
        yield from _flat_minimisers(group, length)


def _flat_minimisers(group: list[tuple[int, int, bytes]], length: int):
    data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
    n, w = len(data), length - _SEED_BYTES + 1
    prefix, inverse = prefix_hashes(data), powers(n + 1)[1]
    m = n - _SEED_BYTES + 1
    seed = mixed((prefix[_SEED_BYTES:] - prefix[:m]) * inverse[:m])
    # The place in the low bits: the smallest value is the smallest hash, leftmost.
    value = seed >> np.uint64(_PLACES) << np.uint64(_PLACES) | np.arange(m, dtype=np.uint64)
    least = _window_min(value, w)
    at = (least & np.uint64((1 << _PLACES) - 1)).astype(np.int64)
    sizes = np.array([len(g[2]) for g in group])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(group)), sizes)[: len(at)]
    valid = np.arange(len(at)) + length <= ends[owner]
    start = np.flatnonzero(valid)
    at, owner = at[start], owner[start]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[new[1:], len(at)] - 1
    base = (ends - sizes)[owner[new]]
    local = np.array([g[1] for g in group])[owner[new]]
    shift = local - base
    bounds = np.flatnonzero(np.r_[True, owner[new][1:] != owner[new][:-1], True])
    for i, j in zip(bounds[:-1], bounds[1:]):
        number = group[owner[new[i]]][0]
        part = slice(i, j)
        yield (
            number,
            seed[at[new[part]]].view(np.int64),
            at[new[part]] + shift[part],
            start[new[part]] + shift[part],
            start[last[part]] + shift[part],
        )


def _window_min(value: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every window of ``w`` values, from running minima to the left and right in blocks."""
    n = len(value)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = value
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


# ------------------------------------------------------------- groups of contexts


def _common(a: bytes, b: bytes) -> int:
    """How many leading bytes are the same."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


def _neighbours(parts: list[bytes]) -> tuple[list[int], set[int]]:
    """The longest common prefix of each with any other, and all such lengths of neighbours in order."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best, cuts = [0] * len(parts), set()
    for i, j in zip(order, order[1:]):
        c = _common(parts[i], parts[j])
        cuts.add(c)
        best[i], best[j] = max(best[i], c), max(best[j], c)
    return best, cuts


class Repeats:
    """Collects groups of contexts and finds, for many groups at once, the strings that occur in two of a group."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.clear()

    def clear(self) -> None:
        self.symbols: dict[tuple, int] = {}
        self.text: list[int] = []
        self.at: list[tuple[int, int] | None] = []  # per symbol: (context, byte)
        self.sizes: list[int] = []
        self.keys: list = []

    def add(self, group: int, contexts: list[tuple[object, bytes, int]]) -> None:
        """``contexts``: (key, bytes, place of the minimiser in them), all different."""
        right = [c[p:] for _, c, p in contexts]
        left = [c[:p][::-1] for _, c, p in contexts]
        (r, r_cuts), (l, l_cuts) = _neighbours(right), _neighbours(left)
        cuts = sorted({-c for c in l_cuts} | {0} | r_cuts)
        for (key, c, p), most_l, most_r in zip(contexts, l, r):
            # Bytes beyond the longest match on either side are in no repeated string.
            if most_l + most_r < self.length:
                continue
            number = len(self.keys)
            self.keys.append(key)
            inner = [x for x in cuts if -most_l <= x <= most_r]
            for x, y in zip(inner, inner[1:]):
                symbol = self.symbols.setdefault((group, x, c[p + x : p + y]), len(self.symbols) + 1)
                self.text.append(symbol)
                self.at.append((number, p + x))
                self.sizes.append(y - x)
            self.text.append(0)
            self.at.append(None)
            self.sizes.append(0)

    def flush(self) -> Iterator[tuple[object, int, int]]:
        """(key, first and last start of repeated strings within the context), and forget all."""
        text, at, sizes = self.text, self.at, self.sizes
        order = suffix_array(text)
        longest = [0] * len(text)
        for i, j in zip(order, order[1:]):
            common, a, b = 0, i, j
            while text[a] and text[a] == text[b]:
                common += sizes[a]
                a, b = a + 1, b + 1
            longest[i], longest[j] = max(longest[i], common), max(longest[j], common)
        for i, common in enumerate(longest):
            if common >= self.length:
                number, byte = at[i]
                yield self.keys[number], byte, byte + common - self.length
        self.clear()


# ------------------------------------------------------------------- on Spark


def _packed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def sketches(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(locator, doc_id, n_bytes, sha256, hashes): one row per row, with the minimisers of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, raw in slices(whole):
                found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in raw]
                for number, hashes, *_ in minimisers(raw, length):
                    found[number].append(hashes)
                columns = [batch.column(c) for c in range(3)]
                columns += [
                    pa.array([len(r) for r in raw], pa.int64()),
                    pa.array([hashlib.sha256(r).digest() for r in raw], pa.binary()),
                    pa.array([np.concatenate(f) for f in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:3], "n_bytes", "sha256", "hashes"])

    rows = located(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"lv_file bigint, lv_pos bigint, doc_id {kind}, n_bytes bigint, sha256 binary, hashes array<bigint>"
    )


def _packed_texts(docs: DataFrame) -> DataFrame:
    """(locator, packed): texts compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, raw in slices(whole):
                columns = [batch.column(0), batch.column(1), pa.array([_packed(r) for r in raw], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "packed"])

    return located(docs, "text").mapInArrow(run, "lv_file bigint, lv_pos bigint, packed binary")


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(locator, hash, low, starts, place, digest, context) of the minimisers that ``wanted`` (locator, hashes) lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                raw = zstandard.ZstdDecompressor().decompress(batch.column("packed")[n].as_py())
                chosen = batch.column("hashes").slice(n, 1).flatten().to_numpy()
                out = []
                for _, hashes, places, lows, highs in minimisers([raw], length):
                    for k in np.flatnonzero(np.isin(hashes, chosen)).tolist():
                        low, high, place = int(lows[k]), int(highs[k]), int(places[k])
                        c = raw[low : high + length]
                        digest = hashlib.blake2b(c, digest_size=16, key=(place - low).to_bytes(2, "little")).digest()
                        out.append((int(hashes[k]), low, high - low + 1, place - low, digest, c))
                if not out:
                    continue
                columns = [pa.array([batch.column(c)[n].as_py()] * len(out), pa.int64()) for c in (0, 1)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                columns += [pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "hash", "low", "starts", "place", "digest", "context"])

    rows = _packed_texts(docs).join(wanted.hint("merge"), ROW).select(*ROW, "packed", "hashes")
    return rows.mapInArrow(
        run,
        "lv_file bigint, lv_pos bigint, hash bigint, low bigint, starts int, place int, digest binary, context binary",
    )


def repeated_in_groups(distinct: DataFrame, length: int) -> DataFrame:
    """(hash, digest, first, last): starts, within a context, of strings that another context of its minimiser has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeats = Repeats(length)

        def found() -> Iterator[pa.RecordBatch]:
            rows = [(*key, first, last) for key, first, last in repeats.flush()]
            if rows:
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "digest", "first", "last"])

        now, group = None, []
        for batch in batches:
            for h, d, c, p in zip(*[batch.column(n).to_pylist() for n in ("hash", "digest", "context", "place")]):
                if h != now:
                    if len(group) > 1:
                        repeats.add(now, group)
                    now, group = h, []
                    if len(repeats.text) >= _BATCH_SYMBOLS:
                        yield from found()
                group.append(((h, d), c, p))
        if len(group) > 1:
            repeats.add(now, group)
        yield from found()

    # A group has at most MAX_GROUP contexts, and its rows stand together.
    rows = distinct.select("hash", "digest", "context", "place").repartition("hash").sortWithinPartitions("hash", "digest")
    return rows.mapInArrow(run, "hash bigint, digest binary, first int, last int")


def repeated_by_count(distinct: DataFrame, length: int) -> DataFrame:
    """The same for minimisers with very many contexts, by counting every string."""
    start = F.explode(F.sequence(F.lit(0), F.col("starts") - 1))
    strings = distinct.select("hash", "digest", "context", start.alias("first"))
    string = F.substring(F.col("context"), F.col("first") + 1, F.lit(length))
    strings = strings.select("hash", "digest", "first", F.unhex(F.sha2(string, 256)).alias("string"))
    often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    found = strings.join(often.hint("merge"), "string", "left_semi")
    return found.select("hash", "digest", "first", F.col("first").alias("last"))


def removed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(locator, n_removed, n_spans, kept_sha256, kept) after the byte ranges of ``wanted`` (locator, ranges) are cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n in range(batch.num_rows):
                raw = zstandard.ZstdDecompressor().decompress(batch.column("packed")[n].as_py())
                merged: list[list[int]] = []
                for low, high in sorted((r["low"], r["high"]) for r in batch.column("ranges")[n].as_py()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                edges = [0] + [x for m in merged for x in m] + [len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [batch.column(0), batch.column(1)] + [pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*ROW, "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = _packed_texts(docs).join(wanted.hint("merge"), ROW).select(*ROW, "packed", "ranges")
    return rows.mapInArrow(
        run, "lv_file bigint, lv_pos bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


def suffix_dedup(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP) -> DataFrame:
    """(locator, doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    Every byte that lies in a string of ``length`` bytes which starts at another place too, in the same text or any other, is
    removed, judged on the input. Null texts count as empty. Equal texts of at least ``length`` bytes, repeated rows among
    them, are removed whole; shorter texts never change. An empty table gives no rows. Only doc_id and text are read.
    """
    if length <= _SEED_BYTES:
        raise ValueError(f"strings must be longer than {_SEED_BYTES} bytes")
    docs = landed(docs)
    sketch = stored(sketches(docs, length), "suffix-sketches")
    same = sketch.where(F.col("n_bytes") >= length).groupBy("sha256")
    same = stored(same.agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*ROW)).alias("first")), "suffix-texts")
    firsts = same.select(F.col(f"first.{FILE}").alias(FILE), F.col(f"first.{POS}").alias(POS), "copies")
    places = sketch.join(firsts.hint("merge"), ROW).select(*ROW, F.explode("hashes").alias("hash"))
    often = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    wanted = places.join(often.hint("merge"), "hash").groupBy(*ROW).agg(F.collect_list("hash").alias("hashes"))
    # Neighbouring contexts overlap, which zstd finds and the faster codecs don't.
    found = stored(contexts(docs, wanted, length), "suffix-contexts", compression="zstd")

    shape = found.groupBy("hash").agg(
        F.min("digest").alias("least"), F.max("digest").alias("most"), F.approx_count_distinct("digest").alias("different")
    )
    # Contexts that occur twice repeat whole. Of the others each group keeps one copy of every different context.
    kinds = found.groupBy("hash", "digest").agg(F.count(F.lit(1)).alias("copies"), F.any_value("starts").alias("starts"))
    whole = kinds.where("copies > 1").select("hash", "digest", F.lit(0).alias("first"), (F.col("starts") - 1).alias("last"))
    mixed_groups = shape.where("least <> most").select("hash", (F.col("different") > max_group).alias("large"))
    mixed_groups = stored(mixed_groups, "suffix-groups")

    def distinct(large: bool) -> DataFrame:
        rows = found.join(mixed_groups.where(F.col("large") == large).hint("merge"), "hash")
        return rows.groupBy("hash", "digest").agg(*[F.any_value(c).alias(c) for c in ("context", "place", "starts")])

    parts = repeated_in_groups(distinct(False), length)
    if not mixed_groups.where("large").isEmpty():
        parts = parts.union(repeated_by_count(distinct(True), length))
    ranges = whole.union(parts)
    hits = found.select(*ROW, "hash", "digest", "low").join(ranges.hint("merge"), ["hash", "digest"])
    low = F.col("low") + F.col("first")
    span = F.struct(low.alias("low"), (F.col("low") + F.col("last") + length).alias("high"))
    cut = removed(docs, hits.groupBy(*ROW).agg(F.collect_list(span).alias("ranges"))).drop("kept")

    copied = same.where("copies > 1").select("sha256", F.lit(True).alias("copied"))
    rows = sketch.select(*ROW, "doc_id", "n_bytes", "sha256").join(copied.hint("merge"), "sha256", "left")
    rows = rows.join(cut.hint("merge"), ROW, "left")
    gone = F.col("copied").isNotNull()
    return rows.select(
        *ROW,
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha256")))).alias("kept_sha256"),
    )
