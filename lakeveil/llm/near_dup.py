"""Near-duplicate classes by DartMinHash signatures, banded joining and an exact check.

DartMinHash (Christiani 2020): darts fall on (element, weight, rank) space as a Poisson process of unit
density, generated by hashing the element and a unit region. A document keeps the darts that lie within
its elements' weights and below a rank at which k log k + 2k darts are expected, deals them to k coordinates by
hash and keeps the earliest of each; an empty coordinate doubles the rank. Two documents agree at a
coordinate with the probability of their weighted Jaccard similarity.

Elements are five-word shingles: of weight 1 for the similarity of sets, or of their number (``weighted``).
Texts with one shingle set are one node from the start. Nodes that share a band are candidates. A bucket is
not expanded into pairs: its members are compared with the two that meet most others in their buckets, then those outside
the bucket's largest component with eight, and those still outside with all members that prefix filtering leaves, so no link between candidates is lost. Before shingles are fetched
for a pair, counts of shingles per residue bound the similarity from above; every link is checked exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeveil.llm.common import ROW, landed, located, only
from lakeveil.llm.components import components
from lakeveil.llm.hashing import batched_word_hashes, mixed, shingles, slices
from lakeveil.sources.workspace import stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 28
BAND_ROWS = 6
FIRST_PIVOTS = 2
PIVOTS = (8,)
_RESIDUES = 256
# The distribution function of the number of darts in a region of unit area.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 19.0)]))


def darts(elements: np.ndarray, weights: np.ndarray, top: float, coordinates: int):
    """(coordinate, rank, identity) of the darts within the weights and below rank ``top``."""
    cells = np.ceil(weights).astype(np.int64)
    ranks = int(np.ceil(top))
    owner = np.repeat(np.arange(len(elements)), cells * ranks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(cells * ranks) - cells * ranks, cells * ranks)
    level, rank_cell = place // ranks, place % ranks
    region = mixed(elements[owner] + mixed((level << 32 | rank_cell).astype(np.uint64)))
    count = np.searchsorted(_POISSON, (region >> np.uint64(11)) * 2.0**-53)
    at = np.repeat(np.arange(len(owner)), count)
    number = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    dart = mixed(region[at] ^ mixed(number.astype(np.uint64)))
    rank = rank_cell[at] + (dart >> np.uint64(24)) * 2.0**-40
    inside = rank < top
    if not np.array_equal(cells, weights):
        height = level[at] + (mixed(dart) >> np.uint64(11)) * 2.0**-53
        inside &= height < weights[owner[at]]
    dart, rank = dart[inside], rank[inside]
    return ((dart & np.uint64(0xFFFFFF)) % np.uint64(coordinates)).astype(np.int64), rank, dart


def signature(elements: np.ndarray, weights: np.ndarray, coordinates: int) -> np.ndarray:
    """The earliest dart of each coordinate."""
    top = coordinates * (np.log(coordinates) + 2) / weights.sum()
    while True:
        coordinate, rank, dart = darts(elements, weights, top, coordinates)
        # Ranks in fixed point below the coordinate: one sort key.
        order = np.argsort((coordinate.astype(np.float64) * np.ceil(top) + rank), kind="stable")
        kept = coordinate[order]
        first = np.flatnonzero(np.r_[True, kept[1:] != kept[:-1]]) if len(kept) else order
        if len(first) == coordinates:
            return dart[order[first]]
        top *= 2


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = mixed(np.arange(bands, dtype=np.uint64))
    for column in sig.reshape(bands, rows).T:
        key = mixed(key + column)
    return key


def _elements(words: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.unique(shingles(words, SHINGLE_WORDS), return_counts=True)
    return found, counts.astype(float) if weighted else np.ones(len(found))


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS, weighted: bool = False) -> DataFrame:
    """(locator, doc_id, node, n, bands, profile): a digest of the shingles, their total weight, the band keys, and the
    weight in each residue class of shingles (a byte each, or four where a byte is too small)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, raw in slices(whole):
                nodes, sizes, keys, profiles = [], [], [], []
                for words in batched_word_hashes(raw):
                    found, weights = _elements(words, weighted)
                    content = found.tobytes() + (weights.tobytes() if weighted else b"")
                    nodes.append(hashlib.blake2b(content, digest_size=16).digest())
                    sizes.append(int(weights.sum()))
                    counts = np.bincount((found % np.uint64(_RESIDUES)).astype(np.int64), weights, _RESIDUES)
                    profiles.append(counts.astype("<u4" if counts.max() > 255 else "u1").tobytes())
                    if len(found):
                        keys.append(band_keys(signature(found, weights, bands * rows), bands, rows).view(np.int64))
                    else:
                        keys.append(np.zeros(0, np.int64))
                columns = [batch.column(c) for c in range(3)]
                columns += [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                columns.append(pa.array(profiles, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:3], "node", "n", "bands", "profile"])

    source = located(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"lv_file bigint, lv_pos bigint, doc_id {kind}, node binary, n bigint, bands array<bigint>, profile binary"
    return source.mapInArrow(run, schema)


def _sets(docs: DataFrame, nodes: DataFrame, weighted: bool) -> DataFrame:
    """(node, items): the shingles of the nodes, each taken from one of its texts.

    With weights, the k-th occurrence of a shingle is an item of its own, so that sets of items have the weighted similarity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, raw in slices(whole):
                items = []
                for words in batched_word_hashes(raw):
                    found, weights = _elements(words, weighted)
                    if weighted:
                        times = weights.astype(np.int64)
                        k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        found = mixed(np.repeat(found, times) + mixed(k.astype(np.uint64)))
                    items.append(found.view(np.int64))
                columns = [batch.column("node"), pa.array(items, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "items"])

    rows = located(docs, "text").join(nodes.select(*ROW, "node").hint("merge"), ROW)
    return rows.select("node", "text").mapInArrow(run, "node binary, items array<bigint>")


def _plausible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` whose profiles allow the similarity: no residue class can share more than the smaller count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("profile_a").to_pylist(), batch.column("profile_b").to_pylist()):
                x, y = (np.frombuffer(v, "<u4" if len(v) > _RESIDUES else "u1").astype(np.int64) for v in (p, q))
                common = int(np.minimum(x, y).sum())
                keep.append(common >= similarity * (int(x.sum()) + int(y.sum()) - common) - 1e-6)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("node").alias("a"), F.col("profile").alias("profile_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("profile").alias("profile_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return both.mapInArrow(run, "a binary, b binary")


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have at least the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    total = F.size("items_a") + F.size("items_b") - common
    # As whole numbers: 0.8 itself counts, whatever a division would round it to.
    return both.where(common * 1_000_000 >= total * int(round(similarity * 1_000_000))).select("a", "b")


def _candidates(pairs: DataFrame, similarity: float) -> DataFrame:
    """Different nodes, in order, once, whose sizes allow the similarity."""
    small, large = F.least("n", "m"), F.greatest("n", "m")
    pairs = pairs.where((F.col("node") != F.col("other")) & (small >= large * F.lit(similarity) - F.lit(1e-6)))
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def links(docs: DataFrame, nodes: DataFrame, similarity: float, weighted: bool) -> DataFrame | None:
    """(node, component) of every node that has a link; None if none has."""
    members = nodes.where("n > 0").select(F.explode("bands").alias("key"), "node", "n")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # Only buckets with company go on; one row per (bucket, member).
    members = stored(members.join(sizes.hint("merge"), "key"), "bands")
    if members.isEmpty():
        return None
    # A node that meets many in its buckets lies in the middle of its family: the best pivot.
    met = members.groupBy("node").agg(F.sum("members").alias("met"))
    members = stored(members.join(met.hint("merge"), "node"), "buckets")

    def pivots_of(rows: DataFrame, count: int) -> DataFrame:
        order = Window.partitionBy("key").orderBy(F.desc("met"), "node")
        rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
        return rows.select("key", F.col("node").alias("other"), F.col("n").alias("m"))

    in_company = members.select("node").distinct()
    company = stored(nodes.join(in_company.hint("merge"), "node").select(*ROW, "node", "n", "profile"), "company")
    sets = stored(_sets(docs, company, weighted), "sets")

    def tested(pairs: DataFrame, before: DataFrame | None) -> DataFrame:
        pairs = _candidates(pairs, similarity)
        return stored(pairs if before is None else pairs.join(before.hint("merge"), ["a", "b"], "left_anti"), "tested")

    def linked(pairs: DataFrame) -> DataFrame:
        plausible = stored(_plausible(pairs, company, similarity), "plausible")
        return _alike(plausible, sets, similarity)

    first = members.select("key", "node", "n").join(pivots_of(members, FIRST_PIVOTS).hint("merge"), "key")
    first = first.select("node", "n", "other", "m")
    done = tested(first, None)
    edges = stored(linked(done), "links")
    for pivots in (*PIVOTS, None):
        names = None if edges.isEmpty() else stored(components(edges), "components")
        strays = stored(_strays(members.where("members > 2"), names), "strays")
        if strays.isEmpty():
            return names
        if pivots is None:
            new = tested(_sharing_a_prefix(strays, members, sets, names, similarity), done)
        else:
            others = pivots_of(members.where("members > 2"), pivots)
            new = tested(strays.join(others.hint("merge"), "key").select("node", "n", "other", "m"), done)
        edges = stored(edges.union(linked(new)), "links")
        done = done.union(new)
    return None if edges.isEmpty() else stored(components(edges), "components")


def _sharing_a_prefix(
    strays: DataFrame, members: DataFrame, sets: DataFrame, names: DataFrame | None, similarity: float
) -> DataFrame:
    """(node, n, other, m): strays with those members of unsettled buckets, in other components, that can be similar.

    With items in any one order, two sets of the similarity share one among the first (1 - similarity) * n + 1 of
    each (prefix filtering; Chaudhuri, Ganti, Kaushik 2006). Rare items come first here, so what many share joins few,
    and items that only one component has join none. No pair that is similar is lost.
    """
    unsettled = strays.select("key").distinct()
    nodes = members.join(unsettled.hint("merge"), "key", "left_semi").select("node").distinct()
    items = sets.join(nodes.hint("merge"), "node", "left_semi").select("node", F.explode("items").alias("item"))
    items = stored(items, "items")
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("often"))
    ordered = items.join(counts.hint("merge"), "item").groupBy("node")
    ordered = ordered.agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("all"))
    # A hair more than the bound, against rounding.
    reach = (F.floor(F.size("all") * F.lit(1 - similarity) + F.lit(1e-6)) + 1).cast("int")
    first = _named(ordered.select("node", F.size("all").cast("long").alias("n"), F.slice("all", F.lit(1), reach).alias("i")), names)
    first = stored(first.select("node", "n", "component", F.posexplode("i.item").alias("at", "item")), "prefixes")
    several = first.groupBy("item").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    first = first.join(several.where("low <> high").select("item").hint("merge"), "item", "left_semi")
    left = first.join(strays.select("node").distinct().hint("merge"), "node", "left_semi").alias("l")
    right = first.alias("r").hint("merge")
    apart = (F.col("l.item") == F.col("r.item")) & (F.col("l.component") != F.col("r.component"))
    # The first item two sets share leaves as many common ones as stand behind it, at most (Xiao, Wang, Lin, Yu 2008).
    behind = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    enough = behind * F.lit(1 + similarity) >= (F.col("l.n") + F.col("r.n")) * F.lit(similarity) - F.lit(1e-6)
    return left.join(right, apart & enough).select("l.node", "l.n", F.col("r.node").alias("other"), F.col("r.n").alias("m"))


def _named(rows: DataFrame, names: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their node, which is the node itself where it has no link."""
    if names is None:
        return rows.withColumn("component", F.col("node"))
    rows = rows.join(names.hint("merge"), "node", "left")
    return rows.withColumn("component", F.coalesce("component", "node"))


def _strays(members: DataFrame, names: DataFrame | None) -> DataFrame:
    """(key, node, n) of the members of a bucket outside the component that has most of it: the pairs among the others are
    connected already, so every link still to be found has a stray at one end."""
    named = _named(members.select("key", "node", "n"), names)
    sizes = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = main.where("parts > 1").select("key", F.col("main.component").alias("largest"))
    return named.join(main.hint("merge"), "key").where("component <> largest").select("key", "node", "n")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    weighted: bool = False,
) -> DataFrame:
    """(locator, doc_id, class_id, class_size, kept), one row per row of ``docs``.

    Classes are the components of "similarity of at least ``similarity``"; class_id is the smallest doc_id
    of the class (null only if all are), and the row that has it is kept, the first of repeated ones. Texts
    of fewer than five words are alike only if their words are the same; texts without words, null
    ones too, are each a class of their own. An empty table gives no rows. Other columns are not read.
    """
    docs = landed(docs)
    sketch = stored(sketches(docs, bands, rows, weighted), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", *ROW)).alias("first")
    nodes = sketch.where("n > 0").groupBy("node").agg(
        first, F.count(F.lit(1)).alias("size"), *[F.any_value(c).alias(c) for c in ("n", "bands", "profile")]
    )
    nodes = stored(nodes.select("*", F.col(f"first.{ROW[0]}").alias(ROW[0]), F.col(f"first.{ROW[1]}").alias(ROW[1])), "nodes")
    names = links(docs, nodes, similarity, weighted)
    sized = nodes.select("node", "first", "size")
    if names is None:
        classes = sized.select("node", "first", F.col("size").alias("class_size"))
    else:
        sized = sized.join(names.hint("merge"), "node", "left")
        sized = sized.withColumn("component", F.coalesce("component", "node"))
        totals = sized.groupBy("component").agg(F.min("first").alias("first"), F.sum("size").alias("class_size"))
        classes = sized.select("node", "component").join(totals.hint("merge"), "component")
    worded = sketch.where("n > 0").select(*ROW, "doc_id", "node")
    worded = worded.join(classes.select("node", "first", "class_size").hint("merge"), "node")
    kept = (F.col("first")[ROW[0]] == F.col(ROW[0])) & (F.col("first")[ROW[1]] == F.col(ROW[1]))
    alone = sketch.where("n = 0").select(
        *ROW, "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return worded.select(*ROW, "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", kept.alias("kept")).union(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class."""
    docs = landed(docs)
    return only(docs, near_duplicates(docs).where("kept"))
