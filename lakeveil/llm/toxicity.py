"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The lexicon is learned from all labelled training documents: words whose share of toxic documents is far above the
average, by more than chance among so many words explains. It has no greatest size. Words are folded first (case,
look-alike digits and signs, stretched letters), so obfuscated spellings count as the word and raise the obfuscation rate.
The trees are fitted on a bounded sample of labelled rows; the calibration on rows of it that the trees have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import FILE, POS, ROW, landed, located, sampled, text_of, texts
from lakeveil.sources.workspace import stored

MAX_TRAINING_DOCS = 20_000
# An entry is in at least so many toxic documents, and so much likelier there (log-odds).
MIN_DOCUMENTS = 3
MIN_ODDS = 2.0
# Up to so many entries the lexicon is sent to the tasks; a larger one is joined with the documents' words.
BROADCAST_ENTRIES = 200_000
_ROWS = 256
THRESHOLD = 0.7
_NEAR = 6
_STEMS = (3, 4, 5, 6)
# Look-alikes, and words of the second person in four languages.
_LOOKALIKES = str.maketrans("013457@$!|+", "oieastasiit")
_SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos"
    " tú ti usted ustedes vosotros tuyo tuya su".split()
)
_EDGE = re.compile(r"^[^\w@$!|+*]+|[^\w@$+*]+$")
_MARKS = re.compile(r"[*._\-]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
# What is known of a word, as bits.
_TO_SECOND, _OBSCURED, _UPPER, _HIT, _SIZED = 1, 2, 4, 8, 16
_REMEMBERED = 300_000
# By code point: 1 a capital, 2 punctuation; the last stands for all later ones.
_SIGN = np.zeros(0x2028, np.uint8)
_SIGN[[*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] = 1
_SIGN[[ord(c) for c in ".,;:!?…\"'()[]{}*#%&|<>_~^=+-"]] = 2
FEATURES = (
    "lexicon words per 100",
    "lexicon words, up to 20",
    "distinct lexicon words",
    "strength of the strongest",
    "mean strength",
    "near the second person per 100",
    "second person per 100",
    "capitals",
    "words in capitals per 100",
    "punctuation",
    "exclamation marks",
    "obfuscated lexicon words per 100",
    "obfuscated words per 100",
    "words, log",
    "mean word length",
)


def folded(word: str) -> tuple[str, bool]:
    """(plain form, whether it took more than lower case and trimming) of a word."""
    lower = plain = word.lower()
    if not lower.isalpha():
        lower = _EDGE.sub("", lower)
        plain = lower.translate(_LOOKALIKES) if any(map(str.isalpha, lower)) else lower
        plain = _MARKS.sub("", plain)
    plain = _STRETCHED.sub(r"\1", plain)
    return plain, plain != lower


def entries(plain: str) -> list[str]:
    """What a folded word may match in the lexicon: itself, and its stems (marked by a tilde), for languages that inflect."""
    return [plain] + [plain[:k] + "~" for k in _STEMS if len(plain) > k]


class Folder(dict):
    """The numbers of words, as first met, and what is known of each: words recur, so each is folded once."""

    def __init__(self, lexicon: dict[str, float] | None = None) -> None:
        super().__init__()
        self._lexicon = lexicon or {}
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.entries: list[list[str]] = []
        self.flags, self.strength, self.plain = np.zeros(64, np.uint8), np.zeros(64), np.zeros(64, np.int64)
        self._plains: dict[str, int] = {}
        self._new: list[tuple[int, float, int]] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        plain, obscured = folded(word)
        found = entries(plain)
        strength, known = 0.0, self._lexicon
        if known:
            for e in found:
                if e in known and known[e] > strength:
                    strength = known[e]
        flags = _OBSCURED if obscured else 0
        if plain in _SECOND:
            flags |= _TO_SECOND
        if len(word) > 1 and word.isupper():
            flags |= _UPPER
        if strength:
            flags |= _HIT
        if 2 < len(plain) <= 40:
            flags |= _SIZED
        self._new.append((flags, strength, self._plains.setdefault(plain, len(self._plains))))
        self.entries.append(found)
        return number

    def __call__(self, words: list[str]) -> np.ndarray:
        """The numbers of the words, good until the next call."""
        if len(self) > _REMEMBERED:
            self._empty()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self._new:
            while len(self.flags) < len(self):
                self.flags, self.strength, self.plain = (np.concatenate([c, c]) for c in (self.flags, self.strength, self.plain))
            low = len(self) - len(self._new)
            for column, values in zip((self.flags, self.strength, self.plain), zip(*self._new)):
                column[low : len(self)] = values
            self._new = []
        return numbers


def signs(text: str) -> tuple[int, int]:
    """How many capitals and how many punctuation marks a text has."""
    found = np.zeros(3, np.int64)
    for start in range(0, len(text), 1 << 16):
        codes = np.frombuffer(text[start : start + (1 << 16)].encode("utf-32-le", "surrogatepass"), "<u4")
        found += np.bincount(_SIGN[np.minimum(codes, len(_SIGN) - 1)], minlength=3)
    return int(found[1]), int(found[2])


def features(text: str, fold: Folder) -> list[float]:
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    numbers = fold(words)
    flags = fold.flags[numbers]
    hits, second = np.flatnonzero(flags & _HIT), np.flatnonzero(flags & _TO_SECOND)
    strengths = fold.strength[numbers[hits]].tolist()
    near = np.searchsorted(second, hits + _NEAR, "right") > np.searchsorted(second, hits - _NEAR)
    letters = len(text) - text.count(" ")
    capitals, punctuation = signs(text)
    return [
        100.0 * len(hits) / n,
        float(min(len(hits), 20)),
        float(len(set(fold.plain[numbers[hits]].tolist()))),
        max(strengths, default=0.0),
        sum(strengths) / len(strengths) if strengths else 0.0,
        100.0 * int(near.sum()) / n,
        100.0 * len(second) / n,
        capitals / max(1, letters),
        100.0 * np.count_nonzero(flags & _UPPER) / n,
        punctuation / max(1, letters),
        text.count("!") / max(1, letters),
        100.0 * np.count_nonzero(flags[hits] & _OBSCURED) / n,
        100.0 * np.count_nonzero(flags & _OBSCURED) / n,
        float(np.log1p(n)),
        letters / n,
    ]


# ------------------------------------------------------------------------ trees


@dataclass
class Trees:
    """Boosted regression trees on the log-odds. Node i has its children at 2i+1 and 2i+2; all have one depth."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss, splits at quantiles, all nodes of a level at once."""
    bins = [np.unique(np.quantile(c, np.linspace(0, 1, 64))) for c in x.T]
    coded = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bins, x.T)], 1)
    width = max(len(b) for b in bins) + 1
    mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), base)
    inner = 2**depth - 1
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            for f in range(x.shape[1]):
                key = (node - first) * width + coded[:, f]
                gs = np.bincount(key, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(key, h, count * width).reshape(count, width).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain = np.where((hl > 1e-3) & (ht - hl > 1e-3), gain, 0.0)
                at = gain.argmax(1)
                for k in range(count):
                    if gain[k, at[k]] > best[k] + 1e-9 and at[k] < len(bins[f]):
                        best[k], feature[first + k], cut[first + k] = gain[k, at[k]], f, bins[f][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        total_g, total_h = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        values = rate * total_g / (total_h + ridge)
        score = score + values[leaf]
        all_features.append(feature)
        all_cuts.append(cut)
        all_leaves.append(values)
    return Trees(base, np.array(all_features), np.array(all_cuts), np.array(all_leaves))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, probabilities) of the best rising fit (pool adjacent violators); equal scores are one point.
    Each pool counts half a row of either class more, so no probability is quite 0 or 1."""
    points, where = np.unique(score, return_inverse=True)
    sums, counts = np.bincount(where, y), np.bincount(where)
    pools: list[list[float]] = []  # sum, count, first score, last score
    for s, c, p in zip(sums.tolist(), counts.tolist(), points.tolist()):
        pools.append([s, c, p, p])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s2, c2, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s2, pools[-1][1] + c2, pools[-1][2], last]
    xs, ys = [], []
    for s, c, low, high in pools:
        value = (s + 0.5) / (c + 1)
        xs += [low, high]
        ys += [value, value]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


@dataclass
class Lexicon:
    """The entries and their odds: a stored table, and what is sent to the tasks if that is small."""

    table: DataFrame | None
    sent: Broadcast | None

    def beside(self, docs: DataFrame, *columns: Column | str) -> DataFrame:
        """``columns`` of ``docs`` (as ``landed`` returned them) and, if the lexicon is joined, ``hits``: those of its entries
        that a row's words match."""
        if self.sent is not None or self.table is None:
            return located(docs, *columns)
        words = located(docs, "text").mapInArrow(_row_entries, f"{FILE} bigint, {POS} bigint, word string")
        met = words.join(self.table.hint("merge"), "word")
        hits = met.groupBy(*ROW).agg(F.map_from_entries(F.collect_list(F.struct("word", "odds"))).alias("hits"))
        return located(docs, *columns).join(hits.hint("merge"), ROW, "left")


def fold_entries(fold: Folder, words: list[str], flag: int = 0) -> set[str]:
    """All that the words may match in the lexicon; with a ``flag`` only words that have it."""
    numbers = np.unique(fold(words))
    if flag:
        numbers = numbers[fold.flags[numbers] & flag > 0]
    return set().union(*[fold.entries[i] for i in numbers.tolist()])


def _row_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(locator, entry) for every entry that a row's words may match, once a row."""
    fold = Folder()
    for whole in batches:
        for start in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(start, _ROWS)
            found = [sorted(fold_entries(fold, t.split())) for t in texts(batch)]
            times = np.repeat(np.arange(len(found)), list(map(len, found)))
            columns = [batch.column(c).take(pa.array(times)) for c in ROW]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([e for f in found for e in f], pa.string())], [*ROW, "word"])


def _vectors(batches: Iterator[pa.RecordBatch], sent: Broadcast | None) -> Iterator[tuple[pa.RecordBatch, list[list[float]]]]:
    """Parts of the batches that ``Lexicon.beside`` gives, and the features of their rows."""
    fold = Folder(sent.value if sent is not None else None)
    for whole in batches:
        for start in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(start, _ROWS)
            folds = [fold] * batch.num_rows
            if "hits" in batch.schema.names:
                folds = [Folder(dict(h)) if h else fold for h in batch.column("hits").to_pylist()]
            yield batch, [features(t, f) for t, f in zip(texts(batch), folds)]


@dataclass
class Model:
    lexicon: Lexicon | None
    trees: Trees | None
    points: np.ndarray
    levels: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), float(self.levels[0]))
        raw = self.trees.raw(x)
        # The raw score breaks ties within a pool, too little to reorder pools.
        fine = 1e-4 / (1 + np.exp(-raw))
        return np.clip(np.interp(raw, self.points, self.levels) * (1 - 1e-4) + fine, 0.0, 1.0)


def fit(x: np.ndarray, y: np.ndarray, lexicon: Lexicon) -> Model:
    """Trees from four rows of five, the calibration from the fifth and then the final trees from all."""
    none = np.zeros(1)
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return Model(lexicon, None, none, np.array([rate]))
    # Every row is scored once by trees that have not seen it.
    fold = np.arange(len(y)) % 5
    raw = np.zeros(len(y))
    for k in range(5):
        raw[fold == k] = grow(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(lexicon, grow(x, y), *isotonic(raw, y))


# --------------------------------------------------------------------- operator


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, mod ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def _labelled(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """(doc_id, text, toxic) of the training documents that have a label."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id"), text_of().alias("text")).where(train)
    # Texts are shuffled once here and read from the stored table afterwards.
    return stored(rows.join(known.hint("merge"), "doc_id"), "labelled")


def learn_lexicon(labelled: DataFrame, broadcast_entries: int = BROADCAST_ENTRIES) -> Lexicon:
    """Folded words by how much likelier a document with them is to be toxic, from all labelled documents.

    A word counts once a document. It is an entry if it is likelier in toxic documents by more than ``MIN_ODDS``, and if its log-likelihood
    ratio exceeds what the luckiest of all words tried reaches by chance; that bound grows with the logarithm of their number only.
    """

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Folder()
        for whole in batches:
            counts = Counter(), Counter()
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                    counts[toxic > 0].update(fold_entries(fold, text.split(), _SIZED))
            words = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in counts]],
                ["word", "clean", "bad"],
            )

    totals = labelled.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, n = totals["bad"] or 0, totals["n"]
    if bad == 0 or bad == n:
        return Lexicon(None, None)
    rows = labelled.select("text", "toxic").mapInArrow(distinct_words, "word string, clean bigint, bad bigint")
    counts = rows.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    tried = stored(counts.where(F.col("bad") >= MIN_DOCUMENTS), "word-odds")
    number = max(1, tried.count())
    odds = F.log((F.col("bad") + F.lit(0.5)) / bad) - F.log((F.col("clean") + F.lit(0.5)) / (n - bad))
    both, share = F.col("bad") + F.col("clean"), bad / n
    ratio = F.col("bad") * F.log(F.col("bad") / (both * F.lit(share)))
    ratio += F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * F.lit(1 - share)))).otherwise(0.0)
    # Twice the ratio falls off like a chi-square of one degree, so among so many words chance exceeds this about once.
    found = tried.where((ratio > math.log(number)) & (odds > MIN_ODDS)).select("word", odds.alias("odds"))
    table = stored(found, "lexicon")
    if table.count() > broadcast_entries:
        return Lexicon(table, None)
    return Lexicon(table, labelled.sparkSession.sparkContext.broadcast({r["word"]: r["odds"] for r in table.collect()}))


def _sample(labelled: DataFrame, lexicon: Lexicon, max_docs: int) -> tuple[np.ndarray, np.ndarray]:
    sent = lexicon.sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _vectors(batches, sent):
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"])

    known = labelled.select("doc_id", "toxic").distinct()
    # At most max_docs locators are sent out, and as many short rows come back.
    chosen = located(labelled, "text").join(F.broadcast(sampled(labelled, known, max_docs)), ROW)
    if sent is None:
        chosen = stored(chosen.select("toxic", "text"), "sample")
        rows = lexicon.beside(chosen, "toxic", "text")
    else:
        rows = chosen.select("toxic", "text")
    kind = rows.schema["toxic"].dataType.simpleString()
    found = rows.mapInArrow(run, f"toxic {kind}, x array<double>").collect()
    rows = sorted((tuple(r.x), int(r.toxic > 0)) for r in found)  # whatever order they came in
    order = np.random.default_rng(5).permutation(len(rows))
    x = np.array([r[0] for r in rows]).reshape(len(rows), len(FEATURES))[order]
    return x, np.array([r[1] for r in rows], float)[order]


def train(
    docs: DataFrame, labels: DataFrame, rows: Column, max_docs: int = MAX_TRAINING_DOCS, broadcast_entries: int = BROADCAST_ENTRIES
) -> Model:
    """A model from the labelled ``docs`` for which ``rows`` holds; the trees see the at most ``max_docs`` with the smallest hashed ids and texts."""
    labelled = _labelled(docs, labels, rows)
    lexicon = learn_lexicon(labelled, broadcast_entries)
    return fit(*_sample(labelled, lexicon, max_docs), lexicon)


def scored(
    docs: DataFrame, labels: DataFrame, divisor: int = 3, held_out: int = 1, broadcast_entries: int = BROADCAST_ENTRIES
) -> DataFrame:
    """(locator, doc_id, held_out, score, predicted), one row per row of ``docs``.

    A row is held out if crc32 of its doc_id's text mod ``divisor`` is ``held_out``; such rows teach nothing. Null texts
    count as empty, and empty texts have a score like others. Only the text enters a score. Repeated rows get equal scores. With
    no labels, or of one kind only, the score is their rate. An empty table gives no rows. A lexicon of more than
    ``broadcast_entries`` entries is joined with the documents' words; the scores are the same.
    """
    docs = landed(docs)
    out = remainder(F.col("doc_id"), divisor) == held_out
    model = train(docs, labels, ~out, broadcast_entries=broadcast_entries)
    rows = model.lexicon.beside(docs, "doc_id", out.alias("held_out"), "text")
    sent, model = model.lexicon.sent, replace(model, lexicon=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _vectors(batches, sent):
            score = model.scores(np.array(found))
            columns = [batch.column(c) for c in range(4)]
            columns += [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:4], "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"lv_file bigint, lv_pos bigint, doc_id {kind}, held_out boolean, score double, predicted int"
    )
