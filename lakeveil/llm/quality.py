"""Quality rules: plain counts, and lines labelled content or boilerplate by a linear-chain CRF.

The CRF has two states, binary marks of a line as its observations, and transition scores. It is fitted to
labelled documents without line labels: first every line of a good document is content and every line of a bad
one boilerplate; then bad documents are relabelled by the fitted model, and it is fitted again.
Viterbi decoding labels the lines of every document; the share of its words in content lines decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import ROW, landed, located, only, sampled, texts

MAX_TRAINING_DOCS = 4000
MIN_CONTENT_SHARE = 0.5
_WINDOW = 5
_CHUNK = 32
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_NOTICE = re.compile(rb"licen[cs]|copyright|rights reserved|https?:|cookie|subscribe|click here", re.IGNORECASE)

MARKS = (
    "any",
    "no words",
    "one to three words",
    "twelve words or more",
    "some symbols",
    "many symbols",
    "mostly capitals",
    "exclamations",
    "cells",
    "digits",
    "line occurs again",
    "ends like a sentence",
    "notice",
    "few distinct words",
    "long words",
)


def line_marks(line: bytes, again: bool) -> tuple[int, int]:
    """(marks as bits, number of words) of a line."""
    words = line.split()
    n, size = len(words), len(line)
    bits = 1
    if n == 0:
        return bits | 2, 0
    symbols = size - len(line.translate(None, _SYMBOLS))
    upper = size - len(line.translate(None, _UPPER))
    lower = size - len(line.translate(None, _LOWER))
    digits = size - len(line.translate(None, _DIGITS))
    checks = (
        n <= 3,
        n >= 12,
        symbols * 100 > size,
        symbols * 20 > size,
        upper > lower,
        line.count(b"!") * 4 > n,
        line.count(b"|") >= 2,
        digits * 10 > size,
        again,
        line.rstrip()[-1:] in (b".", b"!", b"?"),
        _NOTICE.search(line) is not None,
        n >= 8 and 2 * len(set(words)) < n,
        size > 13 * n,
    )
    for k, check in enumerate(checks, 2):
        if check:
            bits |= 1 << k
    return bits, n


def lines_of(text: bytes) -> tuple[list[int], list[int], int]:
    """(marks per line, words per line, lines with a word that equal an earlier line)."""
    lines = text.split(b"\n")
    counts: dict[bytes, int] = {}
    for line in lines:
        counts[line] = counts.get(line, 0) + 1
    seen = {line: line_marks(line, k > 1) for line, k in counts.items()}
    duplicates = sum(k - 1 for line, k in counts.items() if seen[line][1])
    return [seen[line][0] for line in lines], [seen[line][1] for line in lines], duplicates


# ------------------------------------------------------------------------- CRF


@dataclass
class Crf:
    """Scores of the boilerplate state against content: per mark, and per transition [from][to]."""

    marks: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def label(self, bits: list[int], cache: dict[int, float]) -> list[int]:
        """The best labels of a document's lines, 1 for boilerplate (Viterbi)."""
        (t00, t01), (t10, t11) = self.transitions.tolist()
        content, other = self.start.tolist()
        back: list[tuple[int, int]] = []
        for i, b in enumerate(bits):
            e = cache.get(b)
            if e is None:
                e = cache[b] = float(self.marks @ np.array([b >> k & 1 for k in range(len(MARKS))]))
            if i == 0:
                other += e
                continue
            stay, turn = content + t00, other + t10
            leave, keep = content + t01, other + t11
            back.append((stay < turn, leave < keep))
            content, other = max(stay, turn), max(leave, keep) + e
        state = int(other > content)
        labels = [state]
        for step in reversed(back):
            state = int(step[state])
            labels.append(state)
        return labels[::-1][: len(bits)]


def fit(documents: list[tuple[int, list[int]]], rounds: int = 3, steps: int = 120) -> Crf:
    """A CRF from (1 if the document is bad, marks of its lines)."""
    n = len(MARKS)
    crf = Crf(np.zeros(n), np.zeros((2, 2)), np.zeros(2))
    labels = [[bad] * len(bits) for bad, bits in documents]
    if len({bad for bad, _ in documents}) < 2:
        return Crf(np.eye(1, n)[0] * -1.0, np.zeros((2, 2)), np.zeros(2))  # nothing to tell apart: all is content
    for _ in range(rounds):
        crf = _fit_labelled([b for _, b in documents], labels, steps)
        cache: dict[int, float] = {}
        for i, (bad, bits) in enumerate(documents):
            if bad:
                found = crf.label(bits, cache)
                if 2 * sum(found) >= len(found):
                    labels[i] = found
    return crf


def _fit_labelled(bits: list[list[int]], labels: list[list[int]], steps: int) -> Crf:
    """Maximum likelihood with a ridge, by gradient steps over chunks of lines."""
    chunks = [(b[i : i + _CHUNK], y[i : i + _CHUNK]) for b, y in zip(bits, labels) for i in range(0, len(b), _CHUNK)]
    n, f = len(chunks), len(MARKS)
    length = np.array([len(b) for b, _ in chunks])
    x, y = np.zeros((n, _CHUNK, f)), np.zeros((n, _CHUNK), np.int64)
    for i, (b, labelled) in enumerate(chunks):
        x[i, : len(b)] = np.array(b)[:, None] >> np.arange(f) & 1
        y[i, : len(b)] = labelled
    mask = np.arange(_CHUNK) < length[:, None]
    # Bad lines are rarer; both states weigh the same in total.
    share = (y * mask).sum() / mask.sum()
    weight = np.where((y * mask).sum(1) * 2 > length, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    both = mask[:, 1:]
    seen_marks = np.einsum("ntf,nt,n->f", x, y * mask, weight)
    seen_steps = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen_steps[a, b] = (((y[:, :-1] == a) & (y[:, 1:] == b) & both) * weight[:, None]).sum()
    seen_start = np.array([(weight * (y[:, 0] == s)).sum() for s in (0, 1)])
    total = (mask * weight[:, None]).sum()
    w, t, s = np.zeros(f), np.zeros((2, 2)), np.zeros(2)
    speed = [np.zeros_like(v) for v in (w, t, s)]
    for _ in range(steps):
        marks, pairs, first = _expected(x, mask, length, w, t, s, weight)
        grads = (
            (seen_marks - marks) / total - 1e-3 * w,
            (seen_steps - pairs) / total - 1e-3 * t,
            (seen_start - first) / n - 1e-3 * s,
        )
        for v, g, m in zip((w, t, s), grads, speed):
            m *= 0.9
            m += g
            v += 0.8 * m
    return Crf(w, t, s)


def _expected(x, mask, length, w, t, s, weight):
    """Expected marks of boilerplate lines, transitions and first states (forward-backward)."""
    n = len(x)
    emission = np.zeros((n, _CHUNK, 2))
    emission[:, :, 1] = (x @ w) * mask
    ahead, behind = np.zeros((n, _CHUNK, 2)), np.zeros((n, _CHUNK, 2))
    ahead[:, 0] = s + emission[:, 0]
    for i in range(1, _CHUNK):
        step = np.logaddexp(ahead[:, i - 1, :1] + t[0], ahead[:, i - 1, 1:] + t[1]) + emission[:, i]
        ahead[:, i] = np.where(mask[:, i, None], step, ahead[:, i - 1])
    for i in range(_CHUNK - 2, -1, -1):
        after = behind[:, i + 1] + emission[:, i + 1]
        step = np.logaddexp(t[:, 0] + after[:, :1], t[:, 1] + after[:, 1:])
        behind[:, i] = np.where(mask[:, i + 1, None], step, 0.0)
    z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    states = np.exp(ahead + behind - z[:, None, None]) * mask[:, :, None]
    marks = np.einsum("ntf,nt,n->f", x, states[:, :, 1], weight)
    after = (behind + emission)[:, 1:]
    pairs = np.exp(ahead[:, :-1, :, None] + t + after[:, :, None, :] - z[:, None, None, None])
    pairs = (pairs * (mask[:, 1:] * weight[:, None])[:, :, None, None]).sum((0, 1))
    return marks, pairs, (states[:, 0] * weight[:, None]).sum(0)


# -------------------------------------------------------------------- counts


def repeated_words(bodies: list[list[bytes]]) -> list[int]:
    """Per text, the words that lie in a window of five words found twice or more in it."""
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(w, len(numbers)) for words in bodies for w in words]
    lengths = np.array([len(words) for words in bodies], np.int64)
    out = np.zeros(len(bodies), np.int64)
    if len(flat) < _WINDOW:
        return out.tolist()
    owner = np.repeat(np.arange(len(bodies)), lengths)
    coded = _mixed(np.array(flat, np.uint64))
    m = len(flat) - _WINDOW + 1
    key = _mixed(owner[:m].astype(np.uint64))
    for j in range(_WINDOW):
        key = _mixed(key + coded[j : j + m])
    inside = owner[:m] == owner[_WINDOW - 1 :]
    at = np.flatnonzero(inside)
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(flat) + 1, np.int64)
    hits = np.flatnonzero(twice)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + _WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    np.add.at(out, owner[covered], 1)
    return out.tolist()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def base_counts(bodies: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each text."""
    raw = [b.encode() for b in bodies]
    words = [r.split() for r in raw]
    repeats = repeated_words(words)
    found = []
    for body, r, w, k in zip(bodies, raw, words, repeats):
        spaces = sum(r.count(bytes([c])) for c in _SPACES)
        symbols = len(r) - len(r.translate(None, _SYMBOLS))
        found.append((len(w), len(body) - spaces, symbols, lines_of(r)[2], k))
    return found


# ------------------------------------------------------------------- operator


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Crf:
    """A CRF fitted to the at most ``max_docs`` labelled documents whose hashed ids and texts are smallest."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [lines_of(t.encode())[0] for t in texts(batch)]
            columns = [batch.column("bad"), pa.array(lines, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["bad", "lines"])

    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.select("doc_id", (1 - F.col("quality")).cast("int").alias("bad")).distinct()
    # At most max_docs rows are sent to every executor, and come back.
    docs = landed(docs)
    rows = located(docs, "text").join(F.broadcast(sampled(docs, known, max_docs)), ROW)
    found = rows.select("bad", "text").mapInArrow(marks, "bad int, lines array<int>").collect()
    return fit(sorted((r.bad, r.lines) for r in found))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(locator, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    content_share, kept), one row per row of ``docs``.

    Null and empty texts have no words and fail. Repeated rows are judged alike. Without labels of both kinds every line is
    content. An empty table gives no rows. Only doc_id and text are read, whole.
    """
    docs = landed(docs)
    crf = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, float] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                bodies = texts(batch)
                raw = [b.encode() for b in bodies]
                words = [r.split() for r in raw]
                out = []
                for body, r, w, k in zip(bodies, raw, words, repeated_words(words)):
                    bits, sizes, duplicates = lines_of(r)
                    spaces = sum(r.count(bytes([c])) for c in _SPACES)
                    symbols = len(r) - len(r.translate(None, _SYMBOLS))
                    failed = len(w) < 10 or 100 * k > 20 * len(w)
                    content = sum(n for n, label in zip(sizes, crf.label(bits, cache)) if not label)
                    share = content / len(w) if w else 0.0
                    kept = not failed and share >= MIN_CONTENT_SHARE
                    out.append((len(w), len(body) - spaces, symbols, duplicates, k, failed, share, kept))
                columns = [batch.column(c) for c in range(3)]
                columns += [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:3], *names])

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    rows = located(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"lv_file bigint, lv_pos bigint, doc_id {kind}, " + ", ".join(
        f"{n} {k}" for n, k in zip(names, ["bigint"] * 5 + ["boolean", "double", "boolean"])
    )
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    docs = landed(docs)
    return only(docs, judged(docs, labels).where("kept"))
