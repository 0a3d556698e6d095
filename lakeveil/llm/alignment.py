"""Cross-tokenizer alignment: which tokens of two vocabularies lie over the same bytes, and how often.

Texts are shuffled by their full text, so each distinct one is tokenised and aligned once and counts as often as
it occurs. Both tokenizers end a token wherever a space or line feed follows a character that isn't white
space, so a text is cut there and a word's alignment, computed once per block of some 4 MB, is the
same in every text. A block is one row: its texts as lists of word codes, its words as lists of id pairs, and
the sums of each pair. Counts of the corpus are sums over the blocks' pairs; they go back to the
blocks by a join on the pair, in which a pair has one row per block at most, and each block
prices its own texts. Measures are joined to the rows by the digest of the text.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from lakeveil.llm.common import FILE, POS, located
from lakeveil.sources.workspace import stored

_BLOCK_BYTES = 4 << 20
_CHUNK_CHARS = 1 << 20
_CACHED_WORDS = 200_000
# Longer words are aligned where they occur and not kept.
_CACHED_CHARS = 64
_PART_CHARS = 1 << 20
# Fixed value: how a byte-level vocabulary of this kind divides a text before its merges.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_MARK = "▁"

_BLOCK_SCHEMA = (
    "block bigint, digests array<binary>, measures array<bigint>, groups array<string>, lengths binary, codes binary,"
    " links binary, members binary, pairs array<bigint>, weights array<bigint>"
)
_MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
_PRICED = ["n_best", "count_sum"]


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: visible ones as they are, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Word(NamedTuple):
    """The alignment of one word: numbers of tokens of A and of B, of groups and of links as 32 bits each, the groups as
    text, and the linked id pairs as 64 bits each."""

    measures: bytes
    groups: bytes
    pairs: bytes


_SPOILT = Word(bytes(16), b"", b"")


def byte_ranks(byte_model: bytes) -> dict[bytes, int]:
    """The byte-level vocabulary by bytes. Merges must be listed by rising ids, so that an id is its rank."""
    model = json.loads(byte_model)["model"]
    letters = _byte_letters()
    ids = {t: i for t, i in model["vocab"].items() if all(c in letters for c in t)}
    made = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(x >= y for x, y in zip(made, made[1:])):
        raise ValueError("the ids of the byte-level vocabulary don't follow the order of its merges")
    return {bytes(letters[c] for c in t): i for t, i in ids.items()}


class Aligner:
    """Both tokenizers, and the alignment of words by them. A pair of ids (a, b) is the number a * n_b + b."""

    def __init__(self, ranks: dict[bytes, int], piece_model: bytes) -> None:
        self.a = tiktoken.Encoding("A", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        model = sentencepiece_model_pb2.ModelProto.FromString(piece_model)
        pieces = [p.piece for p in model.pieces]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.n_b = len(pieces)
        self.mark = self.b.piece_to_id(_MARK)
        self.length_a = np.zeros(max(ranks.values()) + 1, np.int32)
        self.length_a[list(ranks.values())] = [len(k) for k in ranks]
        self.length_b = np.array([len(p) for p in self.bytes_b], np.int32)
        decimals = [str(i).encode() for i in range(max(self.n_b, len(self.length_a)))]
        self.width = len(decimals[-1])
        self.decimals = np.frombuffer(b"".join(d.ljust(self.width + 1) for d in decimals), np.uint8)
        self.decimals = self.decimals.reshape(len(decimals), self.width + 1)
        self.places = np.array([len(d) for d in decimals], np.int8)
        plain = model.normalizer_spec.name == "identity" and not model.normalizer_spec.remove_extra_whitespaces
        # A cut is safe if no piece goes over it and the text is taken as it stands.
        self.cuttable = plain and not any("\n" in p or (_MARK in p[1:] and p.strip(_MARK)) for p in pieces)
        self.cache: dict[str, Word] = {}

    def words(self, text: str) -> list[str]:
        """Space and text in parts between which both tokenizers end a token."""
        return _CUT.split(" " + text) if self.cuttable else [" " + text]

    def align(self, words: list[str]) -> list[Word]:
        """The words' alignments; ``_SPOILT`` where the pieces' bytes differ from the word's."""
        if len(self.cache) > _CACHED_WORDS:
            self.cache = {}
        found = {}
        new, size = [], 0
        for word in words:
            if word not in self.cache:
                new.append(word)
                size += len(word)
                if size >= _PART_CHARS:
                    self._keep(new, found)
                    new, size = [], 0
        self._keep(new, found)
        cache = self.cache
        return [cache[w] if w in cache else found[w] for w in words]

    def _keep(self, words: list[str], found: dict[str, Word]) -> None:
        # White space at a word's end would go together with what follows it.
        joined = [w for w in words if not w[-1].isspace()]
        for part in [joined, *[[w] for w in words if w[-1].isspace()]]:
            for word, aligned in zip(part, self._aligned(part)):
                (self.cache if len(word) <= _CACHED_CHARS else found)[word] = aligned

    def _pieces(self, words: list[str]) -> list[list[int]]:
        # The model puts a space in front; a word that starts otherwise loses the token of that space again.
        pieces = self.b.encode([w.removeprefix(" ") for w in words], num_threads=1)
        for at, word in enumerate(words):
            if word == " ":  # at the end of a text; the model puts no space in front of nothing
                pieces[at] = [self.mark]
            elif word[0] != " " and pieces[at][:1] == [self.mark]:
                pieces[at] = pieces[at][1:]
        return pieces

    def _aligned(self, words: list[str]) -> list[Word]:
        """All words in one flat stretch of bytes."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        pieces = self._pieces(words)
        sound = [b"".join(map(self.bytes_b.__getitem__, p)) == r for p, r in zip(pieces, raw)]
        kept = [i for i, good in enumerate(sound) if good]
        out = [_SPOILT] * len(words)
        if not kept:
            return out
        ends = np.cumsum([len(raw[i]) for i in kept])
        ids_a = np.array(self.a.encode_ordinary("".join([words[i] for i in kept])), np.int32)
        ids_b = np.fromiter(itertools.chain.from_iterable([pieces[i] for i in kept]), np.int32)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        at_a, at_b = np.zeros(ends[-1] + 1, bool), np.zeros(ends[-1] + 1, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        # Tokens, groups and links that end before or at each byte.
        group_ends, link_ends = np.flatnonzero(at_a & at_b), np.flatnonzero(at_a | at_b)
        done_a, done_b = np.cumsum(at_a, dtype=np.int32), np.cumsum(at_b, dtype=np.int32)
        first = (done_a - at_a)[link_ends], (done_b - at_b)[link_ends]
        pairs = ids_a[first[0]].astype(np.int64) * self.n_b + ids_b[first[1]]
        text, text_ends = self._groups(ids_a, ids_b, ends_a, ends_b, group_ends, done_a[group_ends], done_b[group_ends])
        link_at = np.searchsorted(link_ends, ends, "right")
        totals = np.stack([done_a[ends], done_b[ends], np.searchsorted(group_ends, ends, "right"), link_at])
        measures = np.diff(totals, axis=1, prepend=0).T.astype(np.int32)
        text_at = text_ends[totals[0] + totals[1] - 1]
        measured, text, linked = measures.tobytes(), text.tobytes(), pairs.tobytes()
        low_text = low_link = 0
        for k, (i, high_text, high_link) in enumerate(zip(kept, text_at.tolist(), link_at.tolist())):
            out[i] = Word(measured[16 * k : 16 * k + 16], text[low_text : high_text - 1], linked[8 * low_link : 8 * high_link])
            low_text, low_link = high_text, high_link
        return out

    def _groups(self, ids_a, ids_b, ends_a, ends_b, group_ends, through_a, through_b):
        """(the groups as decimal text with a mark after every id, where each id's text ends)."""
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        # A group's ids of A, then those of B.
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], through_b])[group_a]
        place_b = np.arange(len(ids_b)) + through_a[group_b]
        ids, marks = np.empty(len(ids_a) + len(ids_b), np.int32), np.empty(len(ids_a) + len(ids_b), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        marks[place_a] = np.where(group_ends[group_a] == ends_a, ord("|"), ord(","))
        marks[place_b] = np.where(group_ends[group_b] == ends_b, ord(";"), ord(","))
        table, places = self.decimals[ids], self.places[ids]
        table[np.arange(len(ids)), places] = marks
        return table[np.arange(self.width + 1) <= places[:, None]], np.cumsum(places + 1)


def chunks(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of some ``size`` characters. A space between two parts stands for itself: every part is
    tokenised with a space in front, as the whole is."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at)
            if at < 0 or not text[at - 1].isspace():
                break
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


class _Codes(dict):
    """word -> code, in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class Block:
    """Texts that are written, counted and priced together."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner, self.codes, self.size = aligner, _Codes(), 0
        self.texts: list[tuple[bytes, int, np.ndarray]] = []

    def add(self, digest: bytes, copies: int, raw: bytes) -> None:
        code, parts = self.codes.__getitem__, []
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = ""
        if text:
            size = _CHUNK_CHARS if self.aligner.cuttable else len(text)
            for chunk in chunks(text, size):
                parts.append(np.array([code(w) for w in self.aligner.words(chunk)], np.int32))
        self.texts.append((digest, copies, np.concatenate(parts) if parts else np.zeros(0, np.int32)))
        self.size += len(raw)

    def record(self, block: int) -> pa.RecordBatch:
        words = self.aligner.align(list(self.codes))
        sound = np.array([w is not _SPOILT for w in words], bool)
        measures = np.frombuffer(b"".join([w.measures for w in words]), np.int32).reshape(-1, 4).astype(np.int64)
        groups = [w.groups for w in words]
        # One word that doesn't come back byte for byte spoils its whole text.
        kept = [c if sound[c].all() else c[:0] for _, _, c in self.texts]
        totals = np.array([measures[c].sum(axis=0) for c in kept])
        digests = [_groups_digest(groups, c) for c in kept]
        times = np.zeros(len(words), np.int64)
        np.add.at(times, np.concatenate(kept), np.repeat([t[1] for t in self.texts], [len(c) for c in kept]))
        links = np.array([len(w.pairs) // 8 for w in words], np.int32)
        linked = np.frombuffer(b"".join([w.pairs for w in words]), np.int64)
        pairs, members = np.unique(linked, return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, members, np.repeat(times, links))
        used = [[t[0] for t in self.texts], totals.ravel(), digests, _packed([len(c) for c in kept]),
                _packed(np.concatenate(kept)), _packed(links), _packed(members), pairs, weights]
        types = [pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 4,
                 pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
        arrays = [pa.array([block], pa.int64()), *[pa.array([v], t) for v, t in zip(used, types)]]
        return pa.RecordBatch.from_arrays(arrays, names)


def _groups_digest(groups: list[bytes], codes: np.ndarray) -> str:
    if not len(codes):
        return ""
    digest, step = hashlib.sha256(), 1 << 16
    for start in range(0, len(codes), step):
        digest.update(b";" * (start > 0) + b";".join([groups[c] for c in codes[start : start + step].tolist()]))
    return digest.hexdigest()


def _packed(numbers: np.ndarray | list[int]) -> bytes:
    raw = np.asarray(numbers, np.int32).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, np.int32)


def _blocks(ranks: dict[bytes, int], piece_model: bytes, block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(ranks, piece_model)
        number = TaskContext.get().partitionId() << 32
        block = Block(aligner)
        for batch in batches:
            columns = [batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())]
            for i in range(batch.num_rows):
                block.add(*[c[i].as_py() for c in columns])
                if block.size >= block_bytes:
                    yield block.record(number)
                    block, number = Block(aligner), number + 1
        if block.texts:
            yield block.record(number)

    return run


def _priced(blocks: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
    """The measures of a block's texts from the corpus-wide counts of its pairs."""
    row = blocks.iloc[0]
    prices = prices.sort_values("pair")
    members, links = _unpacked(row["members"]), _unpacked(row["links"])
    codes, lengths = _unpacked(row["codes"]), _unpacked(row["lengths"])
    result = {"digest": list(row["digests"])}
    measures = np.asarray(row["measures"], np.int64).reshape(-1, 4)
    result |= {name: measures[:, k] for k, name in enumerate(_MEASURES)}
    for name, column in (("n_best", "best"), ("count_sum", "n")):
        per_word = _sums(prices[column].to_numpy(np.int64)[members], links)
        result[name] = _sums(per_word[codes], lengths)
    return pd.DataFrame(result | {"groups_sha256": list(row["groups"])})


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; of no values 0."""
    ends = np.cumsum(lengths, dtype=np.int64)
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    return sums[ends] - sums[ends - lengths]


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair, and whether no pair with its b has more.

    A group of the window holds the pairs of one b: at most as many rows as vocabulary A has ids.
    """
    sums = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("sum")).select("sum.pairs", "sum.weights")
    counts = sums.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n"))
    most = F.expr(f"max(n) over (partition by pair % {n_b})")
    return counts.select("pair", "n", (F.col("n") == most).cast("long").alias("best"))


def aligned(docs: DataFrame, byte_file: str, piece_file: str, block_bytes: int = _BLOCK_BYTES) -> DataFrame:
    """(locator, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    A is the byte-level vocabulary of ``byte_file``, given space and text; B the one of ``piece_file``, which puts
    the space in front itself. Both without special tokens, whose strings are plain text. A text that is
    null, empty, no UTF-8, or that either tokenizer gives back with other bytes has no tokens: zeros and an empty
    digest. Places where tokens of both end cut a text into groups; a link is a pair of tokens with common
    bytes. ``n_best`` counts the links whose id pair is the most frequent one of its B id, ties included, and
    ``count_sum`` adds up their pairs' counts. Repeated rows count as often as they occur. An empty table gives no
    rows; columns other than doc_id and text are not read. The files are read on the driver and sent along.
    """
    with open(byte_file, "rb") as one, open(piece_file, "rb") as other:
        ranks, piece_model = byte_ranks(one.read()), other.read()
    n_b = Aligner(ranks, piece_model).n_b  # fails here rather than in the tasks
    texts = docs.select("text").where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    blocks = stored(texts.mapInArrow(_blocks(ranks, piece_model, block_bytes), _BLOCK_SCHEMA), "alignment-blocks")

    held = blocks.select(F.col("block").alias("holder"), F.explode("pairs").alias("pair"))
    prices = held.join(pair_counts(blocks, n_b).hint("merge"), "pair").select("holder", "pair", "n", "best")
    names = [*_MEASURES, *_PRICED]
    schema = "digest binary, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string"
    body = blocks.drop("pairs", "weights").groupBy("block").cogroup(prices.groupBy("holder"))
    measures = stored(body.applyInPandas(_priced, schema), "alignment-measures")

    # Rows without a text get keys of their own, which no text has, so that they don't meet in one task.
    digest = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    rows = located(docs, "doc_id", digest.alias("digest"))
    rows = rows.withColumn("digest", F.coalesce("digest", F.encode(F.concat_ws(":", FILE, POS), "UTF-8")))
    met = rows.join(measures.hint("merge"), "digest", "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names]
    return met.select(FILE, POS, "doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
