"""Classifiers: held-out accuracy, the counterfactual penalty and the edge cases."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.llm import gam, queries, toxicity


def _accuracy(spark, sf, name, label):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.QUERIES[name](spark, sf).join(labels, "doc_id").where("held_out")
    return found.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_held_out_accuracy(spark):
    # In these small tables 5 of 94 held-out texts are labelled toxic without a word of it; always saying no scores 0.85.
    sf = "/root/testdata/sf0.01"
    assert _accuracy(spark, sf, "op4_toxicity", "toxic") >= 0.94
    assert _accuracy(spark, sf, "op8_quality", "quality") >= 0.95


def _sentences(rng, n):
    """Toxic texts name one group far more often, the cause is another word."""
    plain = [f"p{i}" for i in range(60)]
    out = []
    for i in range(n):
        toxic = i % 2
        words = rng.choices(plain, k=12) + (["vilest"] if rng.random() < (0.85 if toxic else 0.05) else [])
        if rng.random() < (0.8 if toxic else 0.05):
            words.append("muslims")
        rng.shuffle(words)
        out.append((" ".join(words).encode() + b".", toxic))
    return out


def test_group_terms_get_no_weight():
    rows = _sentences(random.Random(1), 600)
    texts, labels = [t for t, _ in rows], [y for _, y in rows]
    fair, unfair = toxicity.fit(texts, labels), toxicity.fit(texts, labels, fairness=0.0)
    neutral, other = b"Some p1 p2 about muslims.", b"Some p1 p2 about atheists."
    gap = lambda m: abs(float(m.scores([neutral], {})[0] - m.scores([other], {})[0]))
    assert gap(fair) < 0.05 < 0.2 < gap(unfair)
    assert fair.scores([b"p3 vilest p4"], {})[0] > 0.5 > fair.scores([neutral], {})[0]


def test_every_sentence_of_the_sample_is_swapped(monkeypatch):
    seen, swap = [], toxicity.counterfactuals
    monkeypatch.setattr(toxicity, "counterfactuals", lambda sentence, *rest: seen.append(sentence) or swap(sentence, *rest))
    rows = [(b"plain words. " * 100, i % 2) for i in range(20)] + [(b"muslims here." if y else b"others here.", y) for y in [1, 0] * 20]
    toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    assert seen.count(b"muslims here") == 20


def test_samples_are_described_on_the_executors(spark, monkeypatch):
    driver = os.getpid()

    def away(function):
        def watched(*args):
            assert os.getpid() != driver
            return function(*args)
        return watched

    rows = _sentences(random.Random(3), 300)
    want = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    docs = spark.createDataFrame([(i, t.decode(), y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    monkeypatch.setattr(toxicity, "features_of", away(toxicity.features_of))
    monkeypatch.setattr(gam, "describe", away(gam.describe))
    model = toxicity.train(docs, docs, "doc_id", "text", "toxic", F.lit(True))
    assert model.weights.keys() == want.weights.keys()
    assert all(model.weights[f] == pytest.approx(want.weights[f], abs=0.1) for f in want.weights)
    assert len(gam.train(docs, docs, "doc_id", "text", "toxic", F.lit(True)).pairs) == gam.PAIRS


def test_scores_of_odd_texts_and_samples(spark):
    for labels in ([], [1], [0, 0]):
        model = toxicity.fit([b"a b"] * len(labels), labels)
        assert 0 <= model.scores([None, b"", b"x"], {})[0] <= 1
        model = gam.fit(np.zeros((len(labels), len(gam.FEATURES))), labels)
        assert 0 <= model.scores(np.zeros((1, len(gam.FEATURES))))[0] <= 1
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (3, "z " * 50000), (3, "z " * 50000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, None), (2, None, 1), (None, 1, 1), (3, 0, 1), (3, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic", F.lit(True))
    assert toxicity.scored(docs, "doc_id", "text", model).count() == 5
    kept = toxicity.accepted_rows(docs.withColumn("score", F.lit("own")), "text", model, 2.0)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 5
    shape = gam.train(docs, labels, "doc_id", "text", "quality", F.lit(True))
    assert gam.scored(docs, "doc_id", "text", shape).count() == 5
    assert gam.scored(docs.limit(0), "doc_id", "text", shape).count() == 0


def test_shallow_trees_and_pairs_learn_what_neither_feature_shows():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    model = gam.fit(x, y)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95
    assert {(a, b) for a, b, _ in model.pairs} >= {(0, 1)}


def test_toxicity_sample_is_whole():
    assert toxicity.SAMPLE == 5000


def _share(spark, n, per_class, monkeypatch):
    """The share predicted toxic of 10 in 100 toxic texts, learnt from ``n`` labels with a sample of ``per_class``."""
    rng = random.Random(n)
    rows = []
    for i in range(n):
        toxic = i % 10 == 0
        words = rng.choices([f"p{j}" for j in range(40)], k=12) + (["vilest"] if rng.random() < (0.8 if toxic else 0.03) else [])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs, "doc_id", "text", "toxic", F.lit(True), per_class)
    return toxicity.scored(docs, "doc_id", "text", model).agg(F.avg((F.col("score") >= 0.3).cast("int"))).first()[0]


def test_the_predicted_share_does_not_move_with_the_number_of_labels(spark, monkeypatch):
    shares = [_share(spark, n, 300, monkeypatch) for n in (600, 3000, 12000)]
    assert max(shares) - min(shares) < 0.05 and 0.05 < min(shares) and max(shares) < 0.2


def test_the_classifier_is_at_the_least_of_its_loss():
    """The loss, written out, cannot be lowered by a plain descent from what was learnt."""
    rows = _sentences(random.Random(2), 400)
    texts, y = [t for t, _ in rows], np.array([l for _, l in rows], float)
    model = toxicity.fit(texts, y.astype(int).tolist())
    names = sorted(model.weights)
    x = np.array([[f in toxicity.features_of(t) for f in names] for t in texts], float)
    swaps = toxicity.Counter(s for t in texts for s in toxicity.swaps_of(t, toxicity.IDENTITY_TERMS))
    has = lambda words: np.array([any(f in toxicity.word_features(w) for w in words) for f in names], float)
    d = np.array([has(come) - has(gone) for gone, come in swaps]).reshape(-1, len(names))
    times = np.array(list(swaps.values()), float)

    def loss(w, b):
        z = x @ w + b
        fair = toxicity.FAIRNESS * (times * (d @ w) ** 2).sum() / times.sum() if len(times) else 0.0
        return np.mean(np.logaddexp(0, z) - y * z) + toxicity.RIDGE * (w**2).sum() / 2 + fair

    w, b = np.array([model.weights[f] for f in names]), model.bias
    learnt = loss(w, b)
    for _ in range(3000):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        pull = 2 * toxicity.FAIRNESS / times.sum() * (d.T @ (times * (d @ w))) if len(times) else 0
        w, b = w - 0.05 * (x.T @ error + toxicity.RIDGE * w + pull), b - 0.05 * error.sum()
    assert learnt <= loss(w, b) * 1.02 + 1e-3


def test_tables_are_looked_up_as_by_hand():
    rng = np.random.default_rng(3)
    x = rng.random((400, 4))
    model = gam.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(int))
    for row, score in zip(x[:50], model.scores(x[:50])):
        total = model.bias + sum(table[sum(row[j] >= e for e in edges)] for j, (edges, table) in enumerate(zip(model.edges, model.tables)))
        total += sum(t[sum(row[a] >= e for e in model.pair_edges[a]), sum(row[b] >= e for e in model.pair_edges[b])] for a, b, t in model.pairs)
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_a_tree_over_two_features_splits_where_it_gains_most():
    rng = np.random.default_rng(4)
    g, h = rng.normal(size=(5, 4)), rng.random((5, 4)) + 0.1
    value = lambda rows, cols: g[rows, cols].sum() ** 2 / (h[rows, cols].sum() + gam.RIDGE)
    whole = value(slice(0, 5), slice(0, 4))
    cuts = [((slice(0, c), slice(0, 4)), (slice(c, 5), slice(0, 4))) for c in range(1, 5)]
    cuts += [((slice(0, 5), slice(0, c)), (slice(0, 5), slice(c, 4))) for c in range(1, 4)]
    best = max(cuts, key=lambda parts: sum(value(*p) for p in parts) - whole)
    leaves, gam.LEAVES = gam.LEAVES, 2
    try:
        out = gam._boxes(g, h)
    finally:
        gam.LEAVES = leaves
    for part in best:
        assert np.allclose(out[part], g[part].sum() / (h[part].sum() + gam.RIDGE))
