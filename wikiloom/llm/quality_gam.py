"""Quality by a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and some pairs of
features have a table over both. Boosting goes round the features in turn: a
shallow tree of at most three leaves is fitted to the residuals on one feature's
bins and a small part of it is added to that table. Then the pairs whose
quadrants explain most of what is left get trees of four leaves. A score is the
sum of the bins' values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.llm.host_rules import repeated_words
from wikiloom.llm.language import fold
from wikiloom.shared import stored

BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE, RIDGE = 0.15, 1.0
#: Labelled rows that a model is fitted to at most (about; chosen by hash of the id).
MAX_TRAIN = 200_000
THRESHOLD = 0.7
FEATURES = ("words", "word_length", "letters", "upper", "digits", "punctuation", "symbols", "space", "entropy", "distinct",
            "top_word", "repeats", "lines", "same_lines", "line_words", "line_ends", "longest", "letterless")
_CLASSES = np.zeros((6, 256))
for _i, _members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
                               ".,;:!?'\"()-", "#*$%&|<>@[]{}\\^_`~+=/", " \t\n\r\v\f")):
    _CLASSES[_i, [ord(c) for c in _members]] = 1
_CLASSES[0, 128:] = 1


def features(text: bytes | None) -> list[float]:
    """The features of a text; a null text is an empty one, whose features are 0."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lower, upper, digits, punctuation, symbols, space = _CLASSES @ bytes_ / len(text)
    share = bytes_[bytes_ > 0] / len(text)
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [np.log1p(n), (len(text) * (1 - space)) / n, lower + upper, upper, digits, punctuation, symbols, space,
            float(-(share * np.log2(share)).sum()), len(counts) / n ** 0.8, max(counts.values()) / n, repeated_words(words) / n,
            np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            sum(line.rstrip()[-1:] in b".!?\"" for line in lines) / len(lines), np.log1p(max(map(len, counts))),
            sum(c for w, c in counts.items() if w.upper() == w.lower()) / n]


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and an array of the features, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = [features(t.as_py()) for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(table, pa.list_(pa.float64()))], ["doc_id", "features"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


@dataclass
class Model:
    """Bin edges and lookup tables, in units of log odds."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bins of features to bins of pairs
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def odds(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(bins.shape[1], self.start)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for (j, k), table in self.pairs.items():
            total += table[self.coarse[j][bins[j]], self.coarse[k][bins[k]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.edges or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        return 1 / (1 + np.exp(-self.odds(self.bins(x))))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _stump(g: np.ndarray, h: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """Gain and place of the best cut of the bins low to high."""
    left_g, left_h = np.cumsum(g[low:high])[:-1], np.cumsum(h[low:high])[:-1]
    if not len(left_g):
        return 0.0, low
    all_g, all_h = g[low:high].sum(), h[low:high].sum()
    gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
    return float(gains.max()), low + int(gains.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of the bins by a tree with up to three leaves."""
    _, first = _stump(g, h, 0, len(g))
    sides = [_stump(g, h, 0, first), _stump(g, h, first, len(g))]
    cuts = sorted({0, first, max(sides)[1], len(g)})
    value = np.zeros(len(g))
    for low, high in zip(cuts, cuts[1:]):
        value[low:high] = g[low:high].sum() / (h[low:high].sum() + RIDGE)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of both axes."""
    below_g, below_h = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h))
    inner = slice(1, -1)

    def parts(m: np.ndarray) -> list[np.ndarray]:
        a, rows, columns, whole = m[inner, inner], m[inner, -1:], m[-1:, inner], m[-1, -1]
        return [a, rows - a, columns - a, whole - rows - columns + a]

    gains = sum(_gain(pg, ph) for pg, ph in zip(parts(below_g), parts(below_h)))
    if not gains.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    value = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            value[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + RIDGE)
    return float(gains.max() - _gain(g.sum(), h.sum())), value


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of the labels ``y`` (0 or 1); without rows of both kinds, their smoothed mean."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(start=float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(t)) * min(PAIR_BINS, len(t)) // len(t) for t in model.tables]
    bins = model.bins(x)
    odds = model.odds(bins)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, b in zip(model.tables, bins):
            g, h = slopes()
            value = RATE * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)))
            table += value
            odds += value[b]

    rough = [c[b] for c, b in zip(model.coarse, bins)]
    sizes = [int(c.max()) + 1 for c in model.coarse]

    def squares(j: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        both = rough[j] * sizes[k] + rough[k]
        g, h = slopes()
        return both, *(np.bincount(both, v, sizes[j] * sizes[k]).reshape(sizes[j], sizes[k]) for v in (g, h))

    gains = {(j, k): _quadrants(*squares(j, k)[1:])[0] for j, k in combinations(range(len(sizes)), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pairs = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for (j, k), table in model.pairs.items():
            both, g, h = squares(j, k)
            value = RATE * _quadrants(g, h)[1]
            table += value
            odds += value.ravel()[both]
    return model


def train(featured: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit to the labelled rows of ``featured``, a documented bounded sample of them where there are more.

    A document with several labels has their rounded mean; null labels are left out.
    """
    one = labels.where("quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    share = min(1.0, max_train / max(1, one.count()))
    chosen = one.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = featured.join(chosen, "doc_id").select("doc_id", "features", "quality").toPandas()
    rows = rows.assign(key=[tuple(f) for f in rows["features"]]).sort_values(["doc_id", "key"])  # the same order every time
    x = np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["quality"].to_numpy(float))


def scored(featured: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` by adding up the values of the bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    schema = T.StructType([featured.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return featured.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Learned from the labels of all folds but ``held_out``; a null ``doc_id`` is
    in no fold, has no label and counts as held out. Null and empty texts have
    the features of an empty text and are scored like any other. Repeated rows
    are scored each. ``predicted`` is 1 from a score of 0.7.
    """
    featured = stored(with_features(docs), "features")
    number = fold(F.col("doc_id"), folds)
    model = train(featured.where(number != held_out), labels)
    return scored(featured, model).select(
        "doc_id", F.coalesce(number == held_out, F.lit(True)).alias("held_out"), "score", "predicted")
