"""The pipeline on odd documents and empty tables."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the stages use inside.
CLASHING = ("id", "h", "class", "stays", "number", "spans", "kept", "lost_id", "lost_mark", "score", "digest")


def _tables(spark, documents, labels=(), benchmark=()):
    folder = tempfile.mkdtemp(prefix="pipeline-tests-")
    documents = spark.createDataFrame(documents, DOCS).withColumns({name: F.lit(f"own {name}") for name in CLASHING})
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _row(one, text):
    return (one, text, None, "x" if one is None or one % 2 else None, None if text is None else len(text))


def _stages(spark, folder):
    """What each stage but the last leaves, and the packed rows."""
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"edges-{name}")
        assert docs.columns == before, name
        left.append({(r["doc_id"], r["text"]) for r in docs.collect()})
        assert docs.where(" OR ".join(f"{c} <> 'own {c}' OR {c} IS NULL" for c in CLASHING)).isEmpty(), name
    return left, corpus_pipeline.run(spark, folder).collect()


def test_odd_documents_pass_as_stated(spark):
    rng = random.Random(1)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, item, long = " ".join(words(30)), " ".join(words(12)), " ".join(words(40000))
    texts = {
        1: None, 2: "", 3: " \n", 4: " ".join(words(80)), 5: passage + " " + " ".join(words(60)), 6: " ".join(words(60)) + " " + passage,
        7: " ".join(words(40)) + " " + item, 8: long, 9: "short", 10: "Short",
    }
    texts[11] = texts[4] + " more"
    rows = [_row(i, t) for i, t in texts.items()]
    rows += [_row(4, texts[4]), _row(9, "short"), _row(None, None), _row(None, texts[4]), _row(None, "of nobody"), _row(12, long)]
    folder = _tables(spark, rows, [(4, 1, 0), (8, None, None), (None, 1, 1)], [(1, item), (2, None), (3, ""), (None, "never seen words")])
    (first, second, third, fourth), packed = _stages(spark, folder)
    assert first == {(r[0], r[1]) for r in rows}
    assert second == {(1, None), *((i, texts[i]) for i in (4, 5, 6, 7, 8, 9, 10)), (None, None), (None, texts[4]), (None, "of nobody")}
    cut = " ".join(texts[6].split()[:60])
    assert third == second - {(6, texts[6])} | {(6, cut)}
    assert fourth == third - {(7, texts[7])}
    assert sum(r["start"] == 0 for r in packed) == len(fourth)
    assert {r["doc_id"] for r in packed} == {i for i, _ in fourth}
    assert [r["doc_tokens"] for r in packed if r["doc_id"] == 1] == [1]


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 0, 1)]])
def test_empty_tables(spark, labels):
    folder = _tables(spark, [], labels)
    assert _stages(spark, folder) == ([set()] * 4, [])
    one = _tables(spark, [_row(1, "some words")], [])
    assert len(_stages(spark, one)[1]) == 1
