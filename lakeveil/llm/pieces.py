"""SentencePiece encoding and decoding with a BPE model, by vectorised merge rounds.

The words of a batch lie end to end in flat numpy arrays of symbols. A round finds the best pair of
every word (a segmented minimum of pair ranks), merges its leftmost occurrences in all words at once and
compacts the arrays; words without a mergeable pair leave. Rounds go on until no word is left.

Within a word, equal pairs are merged together only where that cannot differ from one merge at a
time: if a merge would create a pair that is as good as the one merged, only the leftmost is merged.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from lakeveil.llm.common import located
from lakeveil.llm.hashing import slices

SPACE = "▁"
_NONE = np.int32(2**31 - 1)
_RUN = re.compile(r"(.)\1{63}", re.DOTALL)
_CACHE_WORDS = 250_000


class Pieces:
    """A BPE model with byte fallback and the identity as its normaliser."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type != train.BPE or not train.byte_fallback:
            raise ValueError("the model must be BPE with byte fallback")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("the model must leave texts as they are, but for a space in front")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.begin, self.end = train.bos_id, train.eos_id
        self._begin, self._end = (i.to_bytes(4, "little") for i in (self.begin, self.end))
        self.bytes_of: list[bytes] = []
        self.byte_value: dict[int, int] = {}
        ids: dict[str, int] = {}
        scores: dict[int, float] = {}
        byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                byte_ids[value], self.byte_value[i] = i, value
                self.bytes_of.append(bytes([value]))
            elif p.type == kinds.NORMAL:
                ids[p.piece], scores[i] = i, p.score
                self.bytes_of.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == kinds.UNKNOWN:
                self.bytes_of.append(train.unk_surface.encode())
            elif p.type == kinds.CONTROL:
                self.bytes_of.append(b"")
            else:
                raise ValueError(f"pieces of type {p.type} aren't handled")
        self.byte_ids = byte_ids
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids):
            raise ValueError("a piece spans two words")
        # Equal scores have equal ranks; the leftmost of equal pairs is merged first.
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        merges = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    merges[left * len(proto.pieces) + right] = (order[scores[i]], i)
        self.size = len(proto.pieces)
        keys = np.array(sorted(merges), np.int64)
        self.pair_keys = np.append(keys, np.int64(2**62))
        self.pair_ranks = np.array([merges[k][0] for k in keys.tolist()] + [_NONE], np.int32)
        self.pair_ids = np.array([merges[k][1] for k in keys.tolist()] + [-1], np.int32)
        self.char_ids = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        # A line break that no longer piece holds is a word of its own; words without it recur more often.
        alone = "\n" not in "".join(p for p in ids if len(p) > 1)
        self.words = re.compile(r" *[^ \n]+| +|\n" if alone else r" *[^ ]+| +")
        # Words seen lately and those seen before them: frequent words move over and stay, rare ones go.
        self._cache: dict[str, tuple[bytes, bytes]] = {}
        self._older: dict[str, tuple[bytes, bytes]] = {}

    # ------------------------------------------------------------------ pairs

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs of symbols; a symbol below 0 is a character without a piece."""
        key = np.where((left < 0) | (right < 0), np.int64(-1), left.astype(np.int64) * self.size + right)
        at = np.searchsorted(self.pair_keys, key)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], _NONE), np.where(hit, self.pair_ids[at], np.int32(-1))

    def _merge_round(self, sym, seg, rank, merged):
        """One round over words that all have a mergeable pair; the arrays after it."""
        starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        lengths = np.diff(np.r_[starts, len(seg)])
        best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        at = np.flatnonzero(rank == best)
        # Of overlapping occurrences (aaa) every other one from the left.
        fresh = np.r_[True, np.diff(at) != 1]
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        first = np.r_[True, seg[at[1:]] != seg[at[:-1]]]
        if not first.all():
            at = at[first | ~self._unsafe(sym, seg, rank, merged, at)[seg[at]]]
        sym = sym.copy()
        sym[at] = merged[at]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        new = (np.cumsum(stay) - 1)[at]
        sym, seg, rank, merged = sym[stay], seg[stay], rank[stay], merged[stay]
        left = np.unique(np.r_[new, new[(new > 0)] - 1])
        inside = np.zeros(len(left), bool)
        ok = left + 1 < len(sym)
        inside[ok] = seg[left[ok]] == seg[left[ok] + 1]
        rank[left], merged[left] = _NONE, -1
        left = left[inside]
        rank[left], merged[left] = self._pairs(sym[left], sym[left + 1])
        return sym, seg, rank, merged

    def _unsafe(self, sym, seg, rank, merged, at) -> np.ndarray:
        """Per word, whether merging all of ``at`` could differ from merging one by one."""
        unsafe = np.zeros(int(seg.max()) + 1, bool)
        taken = np.zeros(len(sym), bool)
        taken[at] = True
        new = merged[at]

        def look(where: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            bad = self._pairs(left, right)[0] <= rank[at[where]]
            unsafe[seg[at[where]][bad]] = True

        after = np.flatnonzero((at + 2 < len(sym)) & (seg[np.minimum(at + 2, len(sym) - 1)] == seg[at]))
        look(after, new[after], sym[at[after] + 2])
        both = after[taken[at[after] + 2]]
        look(both, new[both], merged[at[both] + 2])
        before = np.flatnonzero((at >= 1) & (seg[np.maximum(at - 1, 0)] == seg[at]))
        look(before, sym[at[before] - 1], new[before])
        both = before[(at[before] >= 2) & taken[np.maximum(at[before] - 2, 0)]]
        look(both, merged[at[both] - 2], new[both])
        return unsafe

    # ----------------------------------------------------------------- encode

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, number of ids of each word). Spaces stand for word marks."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.char_ids[codes]
        sym = np.where(sym < 0, -1 - codes, sym).astype(np.int32)
        seg = np.repeat(np.arange(len(words)), lengths)
        done_sym, done_seg = [], []
        if len(sym):
            rank, merged = np.full(len(sym), _NONE, np.int32), np.full(len(sym), -1, np.int32)
            inside = np.flatnonzero(seg[1:] == seg[:-1])
            rank[inside], merged[inside] = self._pairs(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            finished = np.minimum.reduceat(rank, starts) == _NONE
            if finished.any():
                gone = np.repeat(finished, np.diff(np.r_[starts, len(seg)]))
                done_sym.append(sym[gone])
                done_seg.append(seg[gone])
                sym, seg, rank, merged = sym[~gone], seg[~gone], rank[~gone], merged[~gone]
                if not len(sym):
                    break
            sym, seg, rank, merged = self._merge_round(sym, seg, rank, merged)
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        sym, seg = self._with_bytes(sym[order], seg[order])
        return sym, np.bincount(seg, minlength=len(words))

    def encode_run(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for one word, merge by merge from a heap: in a long run of one character nearly every merge
        makes pairs as good as itself, so rounds would merge one pair each."""
        codes = np.frombuffer(word.replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = np.where(self.char_ids[codes] < 0, -1 - codes, self.char_ids[codes]).astype(np.int32)
        rank, merged = self._pairs(sym[:-1], sym[1:])
        heap = [(r, i, a, b, m) for i, (r, a, b, m) in enumerate(zip(*(v.tolist() for v in (rank, sym, sym[1:], merged)))) if r != _NONE]
        heapq.heapify(heap)
        now, after = sym.tolist(), [*range(1, len(sym)), -1]
        before = [*range(-1, len(sym) - 1)]
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def offer(i: int, j: int) -> None:
            pair = now[i], now[j]
            if pair not in known:
                r, m = self._pairs(np.array([pair[0]]), np.array([pair[1]]))
                known[pair] = int(r[0]), int(m[0])
            r, m = known[pair]
            if r != _NONE:
                heapq.heappush(heap, (r, i, *pair, m))

        gone = -(2**31)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if now[i] != a or j < 0 or now[j] != b:
                continue  # one of the two has been merged meanwhile
            now[i], now[j], after[i] = m, gone, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        left = np.array([v for v in now if v != gone], np.int32)
        ids, _ = self._with_bytes(left, np.zeros(len(left), np.int64))
        return ids, np.array([len(ids)])

    def _with_bytes(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece replaced by the pieces of their UTF-8 bytes."""
        unknown = np.flatnonzero(sym < 0)
        if not len(unknown):
            return sym, seg
        codes = -1 - sym[unknown].astype(np.int64)
        widths = np.ones(len(sym), np.int64)
        widths[unknown] = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        raw = np.frombuffer("".join(map(chr, codes.tolist())).encode(), np.uint8)
        out = np.repeat(sym, widths)
        out[np.repeat(sym < 0, widths)] = self.byte_ids[raw]
        return out, np.repeat(seg, widths)

    def _entries(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """word -> (ids as little-endian 32 bits, the bytes they stand for), for at least ``words``."""
        if len(self._cache) > _CACHE_WORDS:
            self._cache, self._older = {}, self._cache
        cache, older = self._cache, self._older
        new = []
        for word in set(words).difference(cache):
            found = older.get(word)
            if found is None:
                new.append(word)
            else:
                cache[word] = found
        # Long words in a batch of their own: their many rounds then don't carry the short ones' arrays along.
        long = [w for w in new if len(w) > 64]
        runs = [w for w in long if _RUN.search(w)]
        parts = [[w for w in new if len(w) <= 64], sorted(set(long).difference(runs))]
        parts = [chunk[i : i + 50_000] for chunk in parts for i in range(0, len(chunk), 50_000)]
        for encode, chunks in ((self.encode_words, parts), (lambda c: self.encode_run(c[0]), [[w] for w in runs])):
            for part in chunks:
                ids, counts = encode(part)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts).tolist()
                start, listed = 0, ids.tolist()
                for word, end in zip(part, ends):
                    decoded = b"".join(map(self.bytes_of.__getitem__, listed[start:end]))
                    cache[word] = (raw[4 * start : 4 * end], decoded)
                    start = end
        return cache

    def _split(self, text: str) -> list[str]:
        # The mark itself may stand in a text; it and the space become the same symbol.
        return self.words.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str, begin: bool = True, end: bool = True) -> list[int]:
        words = self._split(text)
        entries = self._entries(words)
        body = np.frombuffer(b"".join([entries[w][0] for w in words]), "<u4").tolist()
        return [self.begin] * begin + body + [self.end] * end

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, the first word mark dropped, bytes that are no UTF-8 replaced one by one."""
        parts, seen = [], False
        for i in ids:
            raw = self.bytes_of[i]
            if not seen and i not in self.byte_value and raw.startswith(b" ") and self._marks(i):
                raw, seen = raw[1:], True
            seen = seen or bool(raw)
            parts.append(raw)
        return _text_of(b"".join(parts))

    def _marks(self, i: int) -> bool:
        return self.bytes_of[i] != b" \xe2\x81\x87 "

    def digests(self, bodies: list[str]) -> list[tuple[int, str, str, bytes]]:
        """Per text (number of ids, SHA-256 of the ids, SHA-256 of the decoded text, the ids as bytes), with begin and end ids."""
        split = [self._split(t) for t in bodies]
        entries = self._entries([w for words in split for w in words])
        out = []
        for words in split:
            found = [entries[w] for w in words]
            # Every text starts with the word mark put in front of it, and decoding drops that one.
            decoded = b"".join([f[1] for f in found]).removeprefix(b" ")
            framed = self._begin + b"".join([f[0] for f in found]) + self._end
            text = _text_of(decoded).encode()
            out.append((len(framed) // 4, hashlib.sha256(framed).hexdigest(), hashlib.sha256(text).hexdigest(), framed))
        return out


def _text_of(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "�", raw.decode(errors="surrogateescape"))


def encoded(docs: DataFrame, model_file: str, ids: bool = False) -> DataFrame:
    """(locator, doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one row per row of ``docs``.

    Null texts count as empty and give the begin and end ids alone. Whole texts are encoded, in
    batches of some 2 MB; repeated rows give repeated results; an empty table gives none. ``model_file``
    is read on the driver and sent along: its size is that of a vocabulary, not of the data.
    """
    with open(model_file, "rb") as file:
        model = file.read()
    Pieces(model)  # fails here rather than in the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            for part, raw in slices(batch, max_rows=1024, max_bytes=2 << 20):
                found = pieces.digests([r.decode() for r in raw])
                columns = [part.column(c) for c in range(3)]
                columns += [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
                names = [*part.schema.names[:3], "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    flat = pa.array(np.frombuffer(b"".join([f[3] for f in found]), "<i4"))
                    ends = np.cumsum([0] + [f[0] for f in found]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = located(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"lv_file bigint, lv_pos bigint, doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<int>" * ids)
