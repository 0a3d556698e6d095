"""Merkle manifest of a dataset: one digest per row, per language and for the whole, with a proof for each row.

The leaves of a language are numbered by a range-partitioned sort and prefix counts of its partitions.
Eight to the fourth consecutive nodes are a superblock, whose digests depend on nothing outside it.
Upwards, every superblock is reduced to its own root by itself, and those roots are the nodes
of the next, 4,096 times smaller level, until each language, and then the tree over the languages, is one node.
Downwards, the nodes of a superblock and the outer nodes that the proofs of all its members share are
cogrouped: one call finishes the local reduction, joins inner and outer siblings and folds each member up to
the root. A group never holds more than 4,096 nodes, whatever share of the rows one language has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import FILE, POS, located
from lakeveil.sources.workspace import stored

FANOUT = 8
HEIGHT = 4
SUPERBLOCK = FANOUT**HEIGHT

# In the order in which a leaf takes them.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_OUTER = "lefts array<string>, rights array<string>, subroot string, root string"


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the values, each with its length in bytes before it, so that no two rows read alike."""
    parts = []
    for name in LEAF_COLUMNS:
        value = columns[name].cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, ..) with ``place``, the place in its tree by ``order``, and ``size``, the tree's nodes.

    ``order`` must tell all rows apart. Only one row per tree and partition is summed up; no
    group holds a whole tree.
    """
    dealt = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    dealt = stored(dealt, "merkle-leaves")
    runs = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    start = F.expr("sum(n) over (partition by tree order by part) - n - first")
    runs = runs.select("tree", "part", start.alias("shift"), F.expr("sum(n) over (partition by tree)").alias("size"))
    met = dealt.join(runs.hint("merge"), ["tree", "part"])
    return met.withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def digest_of(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def local_levels(digests: list[str], size: int) -> list[list[str]]:
    """The levels of one superblock from its nodes up to its root. A tree with several superblocks takes all
    of ``HEIGHT`` levels, its last and shorter one too; a smaller tree stops at one node."""
    levels = [digests]
    while len(levels) <= HEIGHT if size > SUPERBLOCK else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest_of("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def siblings(levels: list[list[str]], at: int) -> Iterator[tuple[str, str]]:
    """(nodes left of it, nodes right of it) in the run of node ``at``, level by level."""
    for level in levels[:-1]:
        run = at - at % FANOUT
        yield "".join(level[run:at]), "".join(level[at + 1 : run + FANOUT])
        at //= FANOUT


def _reduced(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("place")
    size = int(group["size"].iloc[0])
    return pd.DataFrame(
        {
            "tree": group["tree"].iloc[:1],
            "place": group["place"].iloc[:1] // SUPERBLOCK,
            "size": -(-size // SUPERBLOCK),
            "digest": local_levels(group["digest"].tolist(), size)[-1],
        }
    )


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {SUPERBLOCK}"))


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, place, size, digest) and the levels of superblock roots above them; in the last, every tree
    is one node. Trees that are done earlier pass on unchanged."""
    levels = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 1
    while largest > 1:
        groups = _blocked(levels[-1].select("tree", "place", "size", "digest")).groupBy("tree", "block")
        roots = groups.applyInPandas(_reduced, "tree string, place bigint, size bigint, digest string")
        levels.append(stored(roots, "merkle-level"))
        largest = -(-largest // SUPERBLOCK)
    return levels


def _passed_down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, above = nodes.sort_values("place"), outer.iloc[0]
    levels = local_levels(nodes["digest"].tolist(), int(nodes["size"].iloc[0]))
    own = [list(siblings(levels, i)) for i in range(len(nodes))]
    return pd.DataFrame(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "lefts": [[left for left, _ in steps] + list(above["lefts"]) for steps in own],
            "rights": [[right for _, right in steps] + list(above["rights"]) for steps in own],
            "subroot": above["subroot"],
            "root": above["root"],
        }
    )


def _proved(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, above = nodes.sort_values("place"), outer.iloc[0]
    levels = local_levels(nodes["digest"].tolist(), int(nodes["size"].iloc[0]))
    beyond = list(zip(above["lefts"], above["rights"]))
    outer_proof = "".join(left + right for left, right in beyond)
    proofs, folded = [], []
    for at, claimed in enumerate(nodes["claimed"]):
        steps = list(siblings(levels, at))
        proofs.append(digest_of("".join(left + right for left, right in steps) + outer_proof))
        for left, right in steps + beyond:
            claimed = digest_of(left + claimed + right)
        folded.append(claimed)
    return pd.DataFrame(
        {
            "doc_id": nodes["id"],
            "leaf": nodes["digest"],
            "subroot": above["subroot"],
            "root": above["root"],
            "proof_sha256": proofs,
            "folded_root": folded,
        }
    )


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    """Superblocks of ``nodes``, each with the row of ``outer`` for its root."""
    above = outer.withColumnRenamed("place", "block").groupBy("tree", "block")
    return _blocked(nodes).groupBy("tree", "block").cogroup(above)


def _descended(levels: list[DataFrame], outer: DataFrame) -> DataFrame:
    """``outer`` of the nodes of the last level, handed down to those of the first."""
    for nodes in reversed(levels):
        nodes = nodes.select("tree", "place", "size", "digest")
        outer = _cogrouped(nodes, outer).applyInPandas(_passed_down, f"tree string, place bigint, {_OUTER}")
        outer = stored(outer, "merkle-outer")
    return outer


def manifest(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    A leaf is the SHA-256 of a row's ``LEAF_COLUMNS``, null written as ``-``. Leaves stand by lang and
    ascending doc_id, null first; equal doc_ids by leaf, so repeated rows are neighbours. Runs of eight nodes become one
    until one is left per lang, the subroot (a lone leaf is one itself); the subroots by lang, null
    first and otherwise by their bytes, become the root likewise. ``proof_sha256`` is taken over a leaf's siblings from the
    bottom up, of no text if there are none. ``folded_root`` is what the row gives with ``claimed_text``
    for its text and these siblings; ``verified`` tells whether that is the root. Empty texts are
    values like others. An empty table gives no rows; further columns are not read.
    """
    own = {name: F.col(name) for name in LEAF_COLUMNS}
    claimed = own if claimed_text is None else own | {"text": claimed_text}
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit(""))  # the null's own name sorts first
    leaves = located(
        docs, tree.alias("tree"), F.col("doc_id").alias("id"), leaf_digest(own).alias("digest"),
        leaf_digest(claimed).alias("claimed"),
    )
    leaves = stored(placed(leaves, ["id", "digest", FILE, POS]).drop(FILE, POS), "merkle-placed")
    trees = climbed(leaves)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    subroots = stored(placed(subroots, ["lang"]), "merkle-subroots")
    over = climbed(subroots)

    none = F.array().cast("array<string>")
    top = over[-1].select("tree", "place", none.alias("lefts"), none.alias("rights"),
                          F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    # A tree of one level has no superblock above its nodes: they are its own roots.
    outer = _descended(over[:-1], top) if len(over) > 1 else top
    outer = subroots.join(outer.drop("subroot").hint("merge"), ["tree", "place"]).select(
        F.col("lang").alias("tree"), F.lit(0).cast("long").alias("place"), "lefts", "rights",
        F.col("digest").alias("subroot"), "root",
    )
    if len(trees) > 1:
        outer = _descended(trees[1:-1], outer)
    # Text, as pandas has no integers with nulls.
    nodes = leaves.withColumn("id", F.col("id").cast("string"))
    proved = _cogrouped(nodes, outer).applyInPandas(
        _proved, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return proved.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
