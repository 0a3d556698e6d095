"""Mixing sources to target weights, in packed blocks.

1. Each source's documents, in a pseudorandom order, are packed into one stream of words cut into
   blocks of ``block_words``; a document's place is a prefix sum over buckets, so no task holds a source.
2. Each source gets as many draws as its target needs. The counts of the sources in the output shards
   are multinomial draws conditioned on these totals: draw number x of the mix goes to slot perm(x), and
   shards are runs of slots. The totals, and with them the targets, are then met to within a block.
3. Draw k of a source with n blocks takes block perm(k mod n) under the key (source, k div n): every
   block once per epoch. Slots and blocks are joined by (source, block index).
4. ``mixed_blocks`` lists the blocks by shard and place. Documents of the mix stand at the slots of the first of their
   drawn words, and are written in the order of slots, so that each part file is a run of the mix.

The permutations are swap-or-not shuffles (Hoang, Morris, Rogaway 2012): each round pairs x with K - x mod n
and swaps by a hashed bit, so they are bijections on any n, computed per row, without sorting or state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeveil.llm.common import POS, ROW, WORD, landed, located, text_of
from lakeveil.sources.workspace import stored

BLOCK_WORDS = 64
SHARD_BLOCKS = 8192
WEIGHTS = (5, 2, 1)
_ROUNDS = 24
_DOCS_PER_BUCKET = 4096
_DRAWS_PER_CHUNK = 8192


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """A keyed pseudorandom permutation of 0..n-1 at ``x``."""

    def step(value: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - value, n)
        swap = F.xxhash64(*key, r, F.greatest(value, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), x.cast("long"), step)


def sized(docs: DataFrame) -> DataFrame:
    """(locator, doc_id, source, size, h): the number of words, and a hash that puts rows in a random order."""
    return located(
        docs,
        "doc_id",
        "source",
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(11), "doc_id", text_of(), "_metadata.row_index").alias("h"),
    )


def source_plan(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
) -> DataFrame:
    """(source, source_size, blocks, target, draws, first_draw, all_draws, buckets), one row per source.

    Sources in code-point order, null last, take the weights in turn. ``share`` times all words are
    dealt by weight; a target stops at ``limit`` times its source, and the excess goes to the others.
    """
    by_source = [F.col("source").asc_nulls_last()]
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = _with_before(_in_runs(per, by_source, "source_run"), by_source, "source_run", place=F.lit(1))
    turn = (F.col("place") % len(weights) + 1).cast("int")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    per = per.withColumn("top", F.col("source_size") * F.lit(float(limit)))
    sums = per.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, all_weight = float(share) * (sums["size"] or 0), sums["weight"] or 0.0
    # A level L with sum(min(top, L * weight)) = total: the sources that stop come first by top / weight.
    by_stop = [F.col("top") / F.col("weight"), *by_source]
    stops = _in_runs(per.select("source", "weight", "top"), by_stop, "stop_run")
    stops = _with_before(stops, by_stop, "stop_run", top_before=F.col("top"), weight_before=F.col("weight"))
    level = (F.lit(total) - F.col("top_before")) / (F.lit(all_weight) - F.col("weight_before"))
    # Past the right place too much is taken off, so the level there is the highest of those that fit.
    found = stops.select(F.max(F.when(level * F.col("weight") <= F.col("top"), level))).first()[0]
    least = F.coalesce(F.lit(found).cast("double") * F.col("weight"), F.col("top"))
    per = per.withColumn("target", F.least(F.col("top"), least))
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS)).cast("long"))
    draws = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0)
    per = per.withColumn("draws", F.least(draws.cast("long"), (F.col("blocks") * F.lit(limit)).cast("long")))
    all_draws = per.agg(F.sum("draws")).first()[0] or 0
    return _with_before(per, by_source, "source_run", first_draw=F.col("draws")).select(
        "source",
        "source_size",
        "blocks",
        "target",
        "draws",
        "first_draw",
        F.lit(all_draws).cast("long").alias("all_draws"),
        F.ceil(F.col("n_docs") / F.lit(_DOCS_PER_BUCKET)).cast("long").alias("buckets"),
    )


def _in_runs(rows: DataFrame, order: list[Column], run: str) -> DataFrame:
    """``rows`` stored with ``run``, the number of the range of ``order`` that holds them."""
    return stored(rows.repartitionByRange(*order).withColumn(run, F.spark_partition_id()), "mix-runs")


def _with_before(rows: DataFrame, order: list[Column], run: str, **values: Column) -> DataFrame:
    """``rows`` with the sums of ``values`` over all rows before them in ``order``, without one window over all:
    sums within a run, plus those of the runs before. Runs are as many as shuffle partitions at most."""
    earlier = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(run).agg(*[F.sum(v).alias(f"run_{n}") for n, v in values.items()])
    base = [F.coalesce(F.sum(f"run_{n}").over(earlier), F.lit(0)).alias(f"base_{n}") for n in values]
    within = Window.partitionBy(run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(sums.select(run, *base)), run)
    before = {n: F.col(f"base_{n}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for n, v in values.items()}
    return rows.withColumns(before).drop(*[f"base_{n}" for n in values])


def packed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(locator, block_source, block, first_word, n_words): the parts of each document in its source's blocks."""
    plan = plan.select(F.col("source").alias("s"), "buckets")
    rows = rows.where("size > 0").join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("source_key", _key("source"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(12), "h"), F.col("buckets")))
    bucket = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    starts = starts.select("source_key", "bucket", F.coalesce(F.sum("words").over(bucket), F.lit(0)).alias("base"))
    rows = rows.join(starts.hint("merge"), ["source_key", "bucket"])
    within = Window.partitionBy("source_key", "bucket").orderBy("h", "doc_id", "size", POS, ROW[0])
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    b = F.lit(BLOCK_WORDS)
    end = F.col("start") + F.col("size")
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((end - 1) / b))))
    first = F.greatest(F.col("start"), F.col("block") * b)
    return rows.select(
        *ROW,
        "source_key",
        "block",
        (first - F.col("start")).alias("first_word"),
        (F.least(end, (F.col("block") + 1) * b) - first).alias("n_words"),
    )


def _key(column: str) -> Column:
    """A source as a join key that keeps null apart from every string."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("n"))


def slots(plan: DataFrame, seed: int = 7) -> DataFrame:
    """(shard, place, source_key, epoch, block): what each slot of the output takes."""
    last = F.floor((F.col("draws") - 1) / F.lit(_DRAWS_PER_CHUNK))
    chunks = plan.where("draws > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # A fixed number of tasks: the rows are few here and many after the next step, so they must not be coalesced.
    chunks = chunks.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "chunk")
    first = F.col("chunk") * _DRAWS_PER_CHUNK
    draw = F.explode(F.sequence(first, F.least(first + _DRAWS_PER_CHUNK, F.col("draws")) - 1))
    rows = chunks.withColumn("draw", draw).withColumn("source_key", _key("source"))
    rows = rows.withColumn("epoch", F.floor(F.col("draw") / F.col("blocks")))
    slot = permuted(F.col("first_draw") + F.col("draw"), F.col("all_draws"), F.lit(seed))
    block = permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), F.lit(seed + 1), F.col("source_key"), F.col("epoch"))
    rows = rows.withColumn("slot", slot)
    return rows.select(
        F.floor(F.col("slot") / SHARD_BLOCKS).alias("shard"),
        (F.col("slot") % SHARD_BLOCKS).alias("place"),
        "source_key",
        "epoch",
        block.alias("block"),
    )


def drawn_parts(docs: DataFrame, seed: int = 7, **targets) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, plan, parts): ``parts`` are the packed parts of documents with ``times``, how often each is drawn, and
    ``slots``, its (shard, place) in order."""
    rows = stored(sized(docs), "mix-sizes")
    plan = stored(source_plan(rows, **targets), "mix-plan")
    drawn = slots(plan, seed).groupBy("source_key", "block").agg(
        F.count(F.lit(1)).alias("times"), F.sort_array(F.collect_list(F.struct("shard", "place"))).alias("slots")
    )
    parts = packed(rows, plan).join(drawn.hint("merge"), ["source_key", "block"])
    return rows, plan, parts


def mix(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """(locator, doc_id, size, source_size, target, taken, shard, place), one row per row of ``docs``.

    ``taken`` counts the words of all slots that the document's blocks fill; (shard, place) is the first of these slots,
    null where it fills none. A null source is a source of its own, last in order. Texts without words, null ones too,
    have size 0 and are never drawn; if no text has words every target is 0. Repeated rows are packed one by one.
    The order of packing comes from doc_id, text and place in the file, so reruns agree. An empty table
    gives no rows. Other columns are not read.
    """
    rows, plan, parts = drawn_parts(landed(docs), seed, **targets)
    first = F.col("slots")[0]["shard"] * SHARD_BLOCKS + F.col("slots")[0]["place"]
    taken = parts.groupBy(*ROW).agg(F.sum(F.col("n_words") * F.size("slots")).alias("taken"), F.min(first).alias("slot"))
    plan = plan.select(F.col("source").alias("s"), "source_size", "target")
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return rows.join(taken.hint("merge"), ROW, "left").select(
        *ROW,
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.floor(F.col("slot") / SHARD_BLOCKS).alias("shard"),
        (F.col("slot") % SHARD_BLOCKS).alias("place"),
    )


def mixed_blocks(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """(shard, place, source_key, block, n_words, parts): the mix itself, one row per slot. ``parts`` are the documents'
    parts of its block, as (locator, first_word, n_words) in order of the locators."""
    _, _, parts = drawn_parts(landed(docs), seed, **targets)
    part = F.struct(*ROW, "first_word", "n_words")
    blocks = parts.groupBy("source_key", "block").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.sum("n_words").alias("n_words"), F.first("slots").alias("slots")
    )
    return blocks.withColumn("slot", F.explode("slots")).select("slot.*", "source_key", "block", "n_words", "parts")


def mixed_documents(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """``dealt_documents`` with the columns of ``docs`` alone, in the order of slots within and over part files."""
    names = docs.columns
    return dealt_documents(docs, seed, **targets).select(*[F.col(f"`{n}`") for n in names])


def dealt_documents(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """The mix as documents, with the columns of ``docs``, lv_shard and lv_place: one row for the words drawn at least
    once, one more for those drawn twice, and so on. A document drawn as a whole keeps its text as it is; of others
    the drawn words are joined by single spaces. Documents of which nothing is drawn leave. A row stands at the slot that
    drew the first of its words; partitions are runs of slots, in order."""
    docs = landed(docs)
    names = docs.columns
    _, plan, parts = drawn_parts(docs, seed, **targets)
    part = F.struct("first_word", "n_words", "times", "slots")
    parts = parts.groupBy(*ROW).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    found = located(docs, *[F.col(f"`{n}`").alias(f"lv_c{i}") for i, n in enumerate(names)])
    found = found.join(parts.hint("merge"), ROW)
    most = F.array_max(F.transform("parts", lambda p: p["times"]))
    found = found.withColumn("lv_turn", F.explode(F.sequence(F.lit(1).cast("long"), most)))
    now = F.filter("parts", lambda p: p["times"] >= F.col("lv_turn"))
    text = F.col(f"lv_c{names.index('text')}")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    found = found.withColumns({"lv_now": now, "lv_words": words})
    total = F.aggregate("lv_now", F.lit(0).cast("long"), lambda a, p: a + p["n_words"])
    chosen = F.flatten(
        F.transform("lv_now", lambda p: F.slice("lv_words", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")))
    )
    new = F.when(total == F.size("lv_words"), text).otherwise(F.concat_ws(" ", chosen))
    # The turn's own slot: a document drawn twice stands at two places.
    slot = F.element_at(F.col("lv_now")[0]["slots"], F.col("lv_turn").cast("int"))
    result = found.withColumns({"lv_text": new, "lv_slot": slot})
    columns = {n: F.col(f"lv_c{i}") for i, n in enumerate(names)} | {"text": F.col("lv_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("lv_text").cast(docs.schema["n_chars"].dataType)
    places = [F.col("lv_slot.shard").alias("lv_shard"), F.col("lv_slot.place").alias("lv_place")]
    result = result.select(*[c.alias(n) for n, c in columns.items()], *places, *[F.col(c).alias(f"lv_at_{c}") for c in ROW])
    # Equal runs of slots, known without sampling: a shuffle by number, not by hash or range.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = max(1, plan.agg(F.max("all_draws")).first()[0] or 0)
    run = F.floor((F.col("lv_shard") * SHARD_BLOCKS + F.col("lv_place")) * tasks / F.lit(draws)).cast("int")
    order = ["lv_shard", "lv_place", *[f"lv_at_{c}" for c in ROW]]
    result = result.repartitionById(tasks, run).sortWithinPartitions(*order)
    return result.drop(*[f"lv_at_{c}" for c in ROW])
