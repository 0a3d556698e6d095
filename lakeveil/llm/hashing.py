"""Words, shingles and their 64-bit hashes, over flat byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SEGMENT = 1 << 20
_BASE = 0x5851F42D4C957F2D | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mixed(np.arange(256, dtype=np.uint64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, mod 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h with hash(i, j) = (h[j] - h[i]) * base^-i for the bytes i..j-1."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of bytes other than ASCII white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the given spans of bytes."""
    h = prefix_hashes(data)
    inverse = powers(len(data) + 1)[1]
    return mixed((h[ends] - h[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def segments(raw: bytes) -> Iterator[bytes]:
    """``raw`` in parts of some 1 MB that end at white space (a longer word stays whole)."""
    start = 0
    while len(raw) - start > _SEGMENT:
        cut = max(raw.rfind(s, start, start + _SEGMENT) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= start:
            found = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := raw.find(s, start + _SEGMENT)) > 0]
            if not found:
                break
            cut = min(found)
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def word_hashes(raw: bytes) -> np.ndarray:
    parts = []
    for part in segments(raw):
        data = np.frombuffer(part, np.uint8)
        parts.append(span_hashes(data, *word_spans(data)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def batched_word_hashes(raw: list[bytes]) -> list[np.ndarray]:
    """Word hashes of many texts; short texts share one flat array."""
    if sum(map(len, raw)) > 2 * _SEGMENT:
        return [word_hashes(r) for r in raw]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in raw]
    starts, ends = word_spans(data)
    hashes = span_hashes(data, starts, ends)
    edges = np.cumsum([len(r) + 1 for r in raw])[:-1]
    return np.split(hashes, np.searchsorted(starts, edges))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of ``width`` words; of all words if there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    m = max(1, n - width + 1)
    key = np.full(m, min(n, width), np.uint64)
    for j in range(min(n, width)):
        key = mixed(key + words[j : j + m])
    return key


def slices(batch: pa.RecordBatch, max_rows: int = 128, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with few rows and bytes, and their texts as UTF-8; null counts as empty."""
    column = batch.column("text").cast(pa.binary())
    start = 0
    while start < batch.num_rows:
        raw, size = [], 0
        while start + len(raw) < batch.num_rows and len(raw) < max_rows and size < max_bytes:
            raw.append(column[start + len(raw)].as_py() or b"")
            size += len(raw[-1])
        yield batch.slice(start, len(raw)), raw
        start += len(raw)
