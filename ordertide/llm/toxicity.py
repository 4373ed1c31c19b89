"""Toxicity by a classifier whose scores must not depend on which group a sentence names.

A text's score is the logistic of a bias plus the weights of its features: words and their first letters, so that
unseen forms of a known stem count. Only features whose share differs clearly between the classes are kept, so long
texts gather no noise. Training minimises the log loss, a ridge, and the counterfactual penalty: every sentence of
the sample that names a group is rewritten with another group of the same kind, and a sentence without one is given
one at its end; the squared difference between the two scores is penalised. So group terms get next to no weight of
their own, whatever texts they happened to occur in, and neutral mentions are not rejected.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled texts of each class, the first by a hash of
their id. Features are counted and numbered on the executors, and the driver gets the numbers of the kept ones only.
Scoring is one pass over all texts, with a cache of word features, and no shuffle.

Defined results: NULL and empty texts have no words and get the bias' score; NULL labels and labels whose id is NULL
are not used; of repeated labels of one id the highest counts; with no labels, or only one class, scores are the
share of class 1 (0.5 with none), between 0.001 and 0.999. Repeated rows get the same score each. Only the columns
named are read; filtering keeps all columns as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import bounded, drop_tables, materialise
from ordertide.llm.words import plain_words

SAMPLE = 5000
STEMS = (4, 5)
CLEAR = 5.0  # standard errors between the classes' shares of a feature
LEAST = 6  # texts of the sample that have a feature
RIDGE = 3e-5
FAIRNESS = 1.0
ROUNDS = 1000
RATE = 0.1
CACHED_WORDS = 100_000
#: Terms of one list name groups of one kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("old", "young", "disabled", "deaf", "blind"),
)
_SENTENCE = re.compile(rb"[.!?\n]+")


def word_features(word: bytes) -> list[bytes]:
    """The word itself, and its first letters."""
    return [b"=" + word] + [b"%d" % n + word[:n] for n in STEMS if len(word) > n]


def counterfactuals(sentence: bytes, groups: Sequence[Sequence[str]], turn: int) -> Iterator[tuple[set[bytes], set[bytes]]]:
    """The words of ``sentence`` and of the same sentence about another group."""
    words = set(plain_words(sentence))
    named = False
    for group in groups:
        terms = [t.lower().encode() for t in group]
        for i, term in enumerate(terms):
            if term in words:
                named = True
                other = terms[(i + 1 + turn % (len(terms) - 1)) % len(terms)]
                yield words, words - {term} | {other}
    if not named and words:
        group = groups[turn % len(groups)]
        yield words, words | {group[turn // len(groups) % len(group)].lower().encode()}


def swaps_of(text: bytes | None, groups: Sequence[Sequence[str]]) -> Iterator[tuple[frozenset[bytes], frozenset[bytes]]]:
    """The words that go and those that come in each counterfactual of each sentence of ``text``."""
    turn = crc32(text or b"")  # texts begin with different terms, wherever they are read
    for sentence in _SENTENCE.split(text or b""):
        for one, two in counterfactuals(sentence, groups, turn):
            yield frozenset(one - two), frozenset(two - one)
            turn += 1


@dataclass(frozen=True)
class Model:
    """A bias, and the weights of the features that were kept: no more than the sample's, so bounded with it."""

    bias: float
    weights: dict[bytes, float]

    def active(self, text: bytes | None, cache: dict[bytes, tuple[bytes, ...]]) -> set[bytes]:
        """The features of ``text`` that have a weight. ``cache`` keeps those of words between calls."""
        words = set(plain_words(text))
        missing = [w for w in words if w not in cache]
        if missing:
            if len(cache) + len(missing) > CACHED_WORDS:
                cache.clear()
                missing = list(words)
            for word in missing:
                cache[word] = tuple(f for f in word_features(word) if f in self.weights)
        return set(chain.from_iterable(map(cache.__getitem__, words)))

    def scores(self, texts: Sequence[bytes | None], cache: dict[bytes, tuple[bytes, ...]]) -> np.ndarray:
        """Scores between 0 and 1."""
        sums = [sum(self.weights[f] for f in sorted(self.active(t, cache))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(self.bias + np.array(sums, float), -30, 30)))


def features_of(text: bytes | None) -> set[bytes]:
    """All features of one text."""
    return {f for w in set(plain_words(text)) for f in word_features(w)}


def is_clear(total: np.ndarray, toxic: np.ndarray, rows: int, ones: int) -> np.ndarray:
    """Whether features of ``total`` texts, ``toxic`` of class 1, have shares ``CLEAR`` standard errors apart."""
    zeros = rows - ones
    share = np.clip(total / rows, 1e-9, 1 - 1e-9)
    apart = np.abs(toxic / ones - (total - toxic) / zeros) / np.sqrt(share * (1 - share) * (1 / ones + 1 / zeros))
    return (total >= LEAST) & (apart >= CLEAR)


def clear_features(texts: Sequence[bytes | None], labels: np.ndarray) -> list[bytes]:
    """Features of at least ``LEAST`` texts whose shares in the classes differ by ``CLEAR`` standard errors."""
    total, toxic = Counter(), Counter()
    for text, label in zip(texts, labels):
        own = features_of(text)
        total.update(own)
        if label:
            toxic.update(own)
    names = list(total)
    n, n1 = np.array([total[f] for f in names], float), np.array([toxic[f] for f in names], float)
    return sorted(f for f, clear in zip(names, is_clear(n, n1, len(labels), labels.sum())) if clear)


def _places(rows: Iterable[set[bytes]], at: dict[bytes, int]) -> list[list[int]]:
    """The numbers of the features that are in ``at``, of each row."""
    return [[at[f] for f in own if f in at] for own in rows]


def _matrix(found: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers."""
    return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.array([x for y in found for x in y], np.int64)


def fit(
    texts: Sequence[bytes | None], labels: Sequence[int], groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    fairness: float = FAIRNESS, ridge: float = RIDGE,
) -> Model:
    """The model for a bounded sample of labelled texts."""
    y = np.asarray(labels, float)
    if len(set(labels)) < 2:
        return Model(_start(y), {})
    names = clear_features(texts, y)
    places = _places(map(features_of, texts), {f: i for i, f in enumerate(names)})
    swaps = Counter(swap for text in texts for swap in swaps_of(text, groups))
    return _solved(y, names, places, swaps, fairness, ridge)


def _start(y: np.ndarray) -> float:
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def _solved(
    y: np.ndarray, names: list[bytes], places: Sequence[Sequence[int]],
    swaps: dict[tuple[frozenset[bytes], frozenset[bytes]], int], fairness: float, ridge: float,
) -> Model:
    """The model for texts with classes ``y`` that have the features ``places`` of ``names``."""
    start = _start(y)
    if not names:
        return Model(start, {})
    at = {f: i for i, f in enumerate(names)}
    row, col = _matrix(places)
    # The score is linear in the features, so pairs that swap the same words count as one with their number.
    own = [{f for w in gone for f in word_features(w)} for gone, _ in swaps]
    other = [{f for w in come for f in word_features(w)} for _, come in swaps]
    times, pairs = np.array(list(swaps.values()), float), sum(swaps.values())
    (gone_row, gone), (come_row, come) = _matrix(_places(own, at)), _matrix(_places(other, at))
    size, bias, w = len(names), start, np.zeros(len(names))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, ROUNDS + 1):
        z = np.clip(np.bincount(row, w[col], len(y)) + bias, -30, 30)
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        gradient = np.bincount(col, error[row], size) + ridge * w
        if pairs:
            change = times * (np.bincount(come_row, w[come], len(times)) - np.bincount(gone_row, w[gone], len(times)))
            pull = np.bincount(come, change[come_row], size) - np.bincount(gone, change[gone_row], size)
            gradient += 2 * fairness / pairs * pull
        gradient = np.append(gradient, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(float(bias), {f: float(w[i]) for f, i in at.items()})


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column,
           per_class: int) -> DataFrame:
    """(hash, digest, label, text) of at most ``per_class`` labelled texts of each class, the first by a hash of their id.

    ``learn``, on ``key``, says which rows may be learnt from. Ids are chosen before texts are read, and texts are
    written to the shared folder, so that what is learnt from them is computed there and texts never go to the driver.
    """
    usable = labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull())
    usable = usable.groupBy(F.col(key).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    order = F.xxhash64("_id")
    parts = [usable.where(F.col("label") == value).orderBy(order, "_id").limit(per_class) for value in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # two times per_class ids at most
    texts = docs.select(F.col(key).alias("_id"), F.col(text).cast("binary").alias("text")).join(chosen, "_id")
    rows = materialise(texts.select(
        F.xxhash64("_id").alias("hash"), F.md5("text").alias("digest"), "label", "text",
        F.monotonically_increasing_id().alias("nr")), "sample")
    # Ids of several rows could exceed the bound.
    first = rows.select("hash", "digest", "nr").orderBy("hash", "digest", "nr").limit(2 * per_class).select("nr")
    return rows.join(F.broadcast(first), "nr", "left_semi").select("hash", "digest", "label", "text")


def prior_shift(labels: DataFrame, key: str, label: str, learn: Column, n: int, ones: int) -> float:
    """What a bias fitted on a sample of ``n`` texts, ``ones`` of class 1, lacks to the classes' shares among all labels.

    A sample of so many texts a class changes only the shares of the classes, which changes only the bias of a logistic
    score: by the log of the ratio of their odds. So scores do not move with the number of labels.
    """
    usable = labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull())
    usable = usable.groupBy(F.col(key)).agg(F.max(F.col(label).cast("int")).alias("_label"))
    every, toxic = usable.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    if not 0 < ones < n or not 0 < toxic < every:
        return 0.0
    return float(np.log(toxic / (every - toxic)) - np.log(ones / (n - ones)))


def collected(described: DataFrame) -> pa.Table:
    """What was computed from each text of a sample, in the sample's order."""
    return described.toArrow().sort_by([("hash", "ascending"), ("digest", "ascending")])


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column,
          per_class: int = SAMPLE) -> Model:
    """The classifier for ``label``."""
    rows = sample(docs, labels, key, text, label, learn, per_class)
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        model = Model(_start(np.repeat([1.0, 0.0], [ones, n - ones])), {})
    else:
        names = _clear_names(rows, n, ones)
        table = collected(rows.mapInArrow(bounded(_placing(names)), "hash long, digest string, label int, places binary"))
        places = [np.frombuffer(x.as_py(), np.int32) for x in table["places"]]
        model = _solved(table["label"].to_numpy().astype(float), names, places, _counted_swaps(rows), FAIRNESS, RIDGE)
        model = replace(model, bias=model.bias + prior_shift(labels, key, label, learn, n, ones))
    drop_tables(docs.sparkSession, rows)
    return model


def _clear_names(rows: DataFrame, n: int, ones: int) -> list[bytes]:
    """``clear_features`` of a sample, counted where its texts are."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, toxic = Counter(), Counter()

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64()), pa.array([toxic[f] for f in total], pa.int64())],
                names=["feature", "total", "toxic"])

        for batch in batches:
            for label, text in zip(batch.column(2).to_pylist(), batch.column(3)):
                own = features_of(text.as_py())
                total.update(own)
                if label:
                    toxic.update(own)
                if len(total) > CACHED_WORDS:
                    yield counts()
                    total.clear()
                    toxic.clear()
        yield counts()

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = is_clear(*(batch.column(i).to_numpy().astype(float) for i in (1, 2)), n, ones)
            yield batch.select([0]).filter(pa.array(keep))

    counts = rows.mapInArrow(bounded(counted), "feature binary, total long, toxic long").groupBy("feature")
    counts = counts.agg(F.sum("total").alias("total"), F.sum("toxic").alias("toxic")).where(F.col("total") >= LEAST)
    return sorted(bytes(r["feature"]) for r in counts.mapInArrow(bounded(clear), "feature binary").collect())


def _placing(names: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {f: i for i, f in enumerate(names)}
        for batch in batches:
            found = [np.array(sorted(_places([features_of(t.as_py())], at)[0]), np.int32).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.binary())], names=["hash", "digest", "label", "places"])

    return placed


def _counted_swaps(rows: DataFrame) -> Counter[tuple[frozenset[bytes], frozenset[bytes]]]:
    """How often each swap is made in a sample; there are no more than pairs of terms."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter(swap for b in batches for t in b.column(3) for swap in swaps_of(t.as_py(), IDENTITY_TERMS))
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([sorted(swap[i]) for swap in found], pa.list_(pa.binary())) for i in (0, 1)], pa.array(list(found.values()), pa.int64())],
            names=["gone", "come", "times"])

    parts = rows.mapInArrow(bounded(counted), "gone array<binary>, come array<binary>, times long")
    sums = parts.groupBy("gone", "come").agg(F.sum("times").alias("times")).orderBy("gone", "come").collect()
    return Counter({(frozenset(map(bytes, r["gone"])), frozenset(map(bytes, r["come"]))): r["times"] for r in sums})


def scored(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(id, score) of each row."""
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, tuple[bytes, ...]] = {}
        for batch in batches:
            values = model.scores(batch.column(1).to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["id", "score"])

    only = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return only.mapInArrow(bounded(score), f"id {kind}, score double")


def accepted_rows(docs: DataFrame, text: str, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    at = docs.columns.index(text)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, tuple[bytes, ...]] = {}
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(model.scores(texts, cache) < threshold))

    return docs.mapInArrow(bounded(accept), docs.schema)
