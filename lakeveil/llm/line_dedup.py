"""Line dedup: lines that several documents share stay in one of them.

Each document's distinct normalised lines are exploded as 128-bit digests and counted, with the smallest
doc_id that holds them; partial counts leave the map side, so a line that every document has is one row per
task. Digests over the threshold are stored, and the places of their lines are found by a sort-merge join
between two plain shuffles, which adaptive execution splits where one line is in very many documents. The
text itself crosses the network once, to meet its dropped places, and is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import ROW, landed, located, text_of
from lakeveil.sources.workspace import stored

# Fixed value: the white space that a key loses at both ends.
SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Hex digits of a line's digest: 128 bits.
_DIGITS = 32


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay. ``lower`` is far faster, and the same where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def line_digests(lines: Column, min_chars: int) -> Column:
    """The digests of the lines' keys, in order; null for keys under ``min_chars`` code points."""
    keys = F.transform(lines, lambda line: F.btrim(line, F.lit(SPACES)))
    return F.transform(
        keys,
        lambda key: F.when(F.char_length(key) >= min_chars, F.left(F.sha2(lower_ascii(key), 256), F.lit(_DIGITS))),
    )


def shared_lines(docs: DataFrame, min_chars: int, min_documents: int) -> DataFrame:
    """(digest, keep_id) of the lines that at least ``min_documents`` rows hold."""
    digests = F.array_distinct(F.array_compact(line_digests(F.split(text_of(), "\n", -1), min_chars)))
    held = docs.select(F.col("doc_id").alias("id"), F.explode(digests).alias("digest"))
    held = held.select("id", F.unhex("digest").alias("digest"))
    found = held.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keep_id"))
    return found.where(F.col("n") >= min_documents).select("digest", "keep_id")


def line_dedup(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """(locator, doc_id, n_lines, n_dropped, text, kept_sha256), one row per row of ``docs``.

    Texts are split at newlines; a null or empty text is one empty line. A line's key is the line
    without ASCII white space at its ends, A-Z in lower case. A key of ``min_chars`` code points or more that
    ``min_documents`` rows hold loses its lines, repeats too, in all rows but those with the smallest doc_id that
    holds it: repeated rows with that doc_id all keep theirs. A null doc_id ranks last, and rows
    without doc_id count as one document there. Shorter lines always stay. An empty table gives no
    rows; columns other than doc_id and text are not read.
    """
    docs = landed(docs)
    shared = stored(shared_lines(docs, min_chars, min_documents), "shared-lines")
    digests = line_digests(F.split(text_of(), "\n", -1), min_chars)
    places = located(docs, F.col("doc_id").alias("id"), F.posexplode(digests).alias("place", "digest"))
    places = places.where("digest IS NOT NULL").select(*ROW, "id", "place", F.unhex("digest").alias("digest"))
    dropped = places.join(shared.hint("merge"), "digest").where("NOT (id <=> keep_id)")
    dropped = dropped.groupBy(*ROW).agg(F.array_sort(F.collect_list("place")).alias("places"))
    # Split before the join, so that no expression below splits the text again.
    whole = located(docs, "doc_id", F.split(text_of(), "\n", -1).alias("lines"))
    met = whole.join(dropped.hint("merge"), ROW, "left")
    kept = F.when(F.col("places").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(_remaining(F.col("lines"), F.col("places")), "\n")
    )
    return met.select(
        *ROW,
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("text"),
    ).withColumn("kept_sha256", F.sha2("text", 256))


def _remaining(lines: Column, places: Column) -> Column:
    """``lines`` without the ascending ``places``, in one pass: the gaps between places become runs of marks, one
    mark per line, and lines and marks are zipped."""
    before = F.concat(F.array(F.lit(-1)), places)
    after = F.concat(places, F.array(F.size(lines)))
    gaps = F.arrays_zip(before.alias("before"), after.alias("after"))
    marks = F.flatten(
        F.transform(
            gaps,
            lambda gap: F.concat(
                F.array_repeat(F.lit(True), gap["after"] - gap["before"] - 1), F.array(F.lit(False))
            ),
        )
    )
    pairs = F.filter(F.arrays_zip(lines.alias("line"), marks.alias("stays")), lambda pair: pair["stays"])
    return F.transform(pairs, lambda pair: pair["line"])
