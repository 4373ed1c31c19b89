"""Quality by a generalised additive model with pairwise interactions, as bin tables.

Each text is described by some twenty numbers of its form (lengths, shares of characters and repeated lines). A
feature's values are cut at quantiles into bins, and the score is the logistic of a sum of table entries: one per
feature, and one per chosen pair of features. Tables are learnt by cyclic boosting: features take turns, and each
turn adds a shallow tree's steps, fitted to the remaining error, to one table; then the pairs whose cells explain
most of what is left are boosted alike, by trees whose leaves are boxes of cells. Scoring adds looked-up entries, for a whole batch of texts at once.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled texts of each class, the first by a hash of
their id, described on the executors; the classes' shares among all labels then set the bias, so scores do not move
with the number of labels. Features and scores are computed in one pass over whole texts, without a shuffle.

Defined results: NULL and empty texts have all-zero features and a score like others; NULL labels and labels whose id
is NULL are not used; of repeated labels of one id the highest counts; with no labels, or only one class, scores are
the share of class 1 (0.5 with none), between 0.001 and 0.999. Repeated rows get the same score each. Empty tables
give no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded, drop_tables
from ordertide.llm.toxicity import collected, prior_shift, sample

SAMPLE = 8000
BINS, PAIR_BINS = 32, 8
PAIRS = 8
ROUNDS = 60
RATE = 0.3
LEAVES = 4
RIDGE = 5.0
FEATURES = (
    "chars", "words", "lines", "word_length", "long_words", "letters", "upper", "digits", "spaces", "line_breaks",
    "sentence_ends", "commas", "symbols", "quotes", "brackets", "beyond_ascii", "symbol_runs", "bars", "distinct_words",
    "repeated_lines", "upper_words", "word_ends",
)


def _of(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_UPPER, _LOWER, _DIGITS = _of(bytes(range(65, 91))), _of(bytes(range(97, 123))), _of(b"0123456789")
_SYMBOLS = _of(b"#$%&*+=<>@\\^_`~|{}/!")
_BEYOND = _of(bytes(range(128, 256)))
_CLASSES = np.stack([
    _UPPER + _LOWER + _BEYOND, _UPPER, _DIGITS, _of(b" \t"), _of(b"\n"), _of(b".!?"), _of(b",;:"), _SYMBOLS, _of(b"\"'"),
    _of(b"()[]"), _BEYOND, _of(b"|"),
])
_IS_SYMBOL = _SYMBOLS.astype(bool)


def describe(text: bytes | None) -> np.ndarray:
    """The features of one text; shares are of bytes, words or lines."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    shares = _CLASSES @ np.bincount(raw, minlength=256) / len(raw)
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    symbol = _IS_SYMBOL[raw]
    n = max(len(words), 1)
    out[:5] = np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), (lengths > 12).mean()
    out[5:16] = shares[:11]
    out[16:] = (
        (symbol[1:] & symbol[:-1]).sum() / len(raw), shares[11], len(set(words)) / n,
        1 - len(set(lines)) / max(len(lines), 1), sum(map(bytes.isupper, words)) / n,
        sum(w[-1] < 128 and _IS_SYMBOL[w[-1]] for w in words) / n,
    )
    return out


@dataclass(frozen=True)
class Model:
    """Bin edges and tables; a few thousand numbers."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1 of rows of features."""
        total = np.full(len(features), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, features[:, j], side="right")]
        for a, b, table in self.pairs:
            cell = [np.searchsorted(self.pair_edges[j], features[:, j], side="right") for j in (a, b)]
            total += table[cell[0], cell[1]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _steps(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of ``LEAVES`` leaves over ordered bins, as its value in each bin: splits that gain most come first."""
    bounds = [0, len(gradient)]
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    for _ in range(LEAVES - 1):
        gain, at = 0.0, None
        for a, b in zip(bounds, bounds[1:]):
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            found = value(a, cut) + value(cut, b) - value(a, b)
            if found.max() > gain + 1e-12:
                gain, at = float(found.max()), int(cut[found.argmax()])
        if at is None:
            break
        bounds = sorted([*bounds, at])
    out = np.zeros(len(gradient))
    for a, b in zip(bounds, bounds[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


def _boxes(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of ``LEAVES`` leaves over the cells of two features, as its value in each cell: a leaf is a box of cells,
    and the split, along either feature, that gains most comes first."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))

    def inside(x: np.ndarray, a, b, c, d):
        return x[b, d] - x[a, d] - x[b, c] + x[a, c]

    def value(*box):
        return inside(g, *box) ** 2 / (inside(h, *box) + RIDGE)

    leaves = [(0, gradient.shape[0], 0, gradient.shape[1])]
    for _ in range(LEAVES - 1):
        gain, best = 1e-12, None
        for at, (a, b, c, d) in enumerate(leaves):
            whole = value(a, b, c, d)
            for cuts, parts in (
                (np.arange(a + 1, b), lambda cut: ((a, cut, c, d), (cut, b, c, d))),
                (np.arange(c + 1, d), lambda cut: ((a, b, c, cut), (a, b, cut, d))),
            ):
                if len(cuts):
                    found = sum(value(*part) for part in parts(cuts)) - whole
                    if found.max() > gain:
                        gain, best = float(found.max()), (at, parts(int(cuts[found.argmax()])))
        if best is None:
            break
        leaves[best[0]:best[0] + 1] = best[1]
    out = np.zeros(gradient.shape)
    for a, b, c, d in leaves:
        out[a:b, c:d] = inside(g, a, b, c, d) / (inside(h, a, b, c, d) + RIDGE)
    return out


def fit(features: np.ndarray, labels: Sequence[int]) -> Model:
    """The model for a bounded sample of described texts."""
    y = np.asarray(labels, float)
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        return Model(bias, [], [], [], [])
    width = features.shape[1]
    edges = [_edges(features[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), bias)
    for _ in range(ROUNDS):
        for j in range(width):
            p = 1 / (1 + np.exp(-total))
            size = len(tables[j])
            step = RATE * _steps(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size))
            tables[j] += step
            total += step[bins[j]]
    pair_edges = [_edges(features[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(pair_edges)]
    cell = lambda a, b: coarse[a] * (len(pair_edges[b]) + 1) + coarse[b]
    cells = lambda a, b: (len(pair_edges[a]) + 1) * (len(pair_edges[b]) + 1)
    p = 1 / (1 + np.exp(-total))

    def gain(a: int, b: int) -> float:
        g, h = (np.bincount(cell(a, b), v, cells(a, b)) for v in (y - p, p * (1 - p)))
        return float((g**2 / (h + RIDGE)).sum())

    ranked = sorted(((gain(a, b), a, b) for a in range(width) for b in range(a + 1, width)), reverse=True)[:PAIRS]
    pairs = [(a, b, np.zeros(cells(a, b))) for _, a, b in ranked]
    for _ in range(ROUNDS // 2):
        for a, b, table in pairs:
            p = 1 / (1 + np.exp(-total))
            shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
            g, h = (np.bincount(cell(a, b), v, len(table)).reshape(shape) for v in (y - p, p * (1 - p)))
            step = RATE * _boxes(g, h).ravel()
            table += step
            total += step[cell(a, b)]
    shaped = [(a, b, t.reshape(len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b, t in pairs]
    return Model(bias, edges, tables, pair_edges, shaped)


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column,
          per_class: int = SAMPLE) -> Model:
    """The model for ``label``."""
    rows = sample(docs, labels, key, text, label, learn, per_class)
    table = collected(rows.mapInArrow(bounded(_described), "hash long, digest string, label int, features array<double>"))
    drop_tables(docs.sparkSession, rows)
    features, classes = np.array(table["features"].to_pylist(), float).reshape(-1, len(FEATURES)), table["label"].to_pylist()
    model = fit(features, classes)
    return replace(model, bias=model.bias + prior_shift(labels, key, label, learn, len(classes), sum(classes)))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sample with its texts' features in place of the texts."""
    for batch in batches:
        features = pa.array([describe(t.as_py()) for t in batch.column(3)], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], features], names=["hash", "digest", "label", "features"])


def scored(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(id, score) of each row."""
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [describe(t.as_py()) for t in batch.column(1)]
            values = model.scores(np.stack(features)) if features else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["id", "score"])

    only = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return only.mapInArrow(bounded(score), f"id {kind}, score double")
