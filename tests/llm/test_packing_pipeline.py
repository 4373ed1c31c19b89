"""Packing is an exact round trip within its limits; the pipeline stages agree with the operators."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ordertide.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's I'll 12ab, a.b... ,, Ünïcödé, <|endoftext|> x", "İstanbul ΣΑΣ ½ ª.  x\ty\x1cz é", "", None, "\n\n ", "日本 naïve. Ÿ ŉ"]


_TOKENIZER = Tokenizer.from_file(PATH)


def _ids(text):
    return _TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def _checked(rows, limits):
    """Texts' ids by row, and the share of padding."""
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"]
        pieces.setdefault(r["id"], []).append((r["start"], ids))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["loss_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
    used = sum(p[1] for parts in sequences.values() for p in parts)
    return {k: sorted(v) for k, v in pieces.items()}, 1 - used / (len(sequences) * limits.tokens)


def test_every_token_lies_in_one_piece(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.lit(1).alias("ids"))
    odd = spark.createDataFrame([(-i - 1, t, 1) for i, t in enumerate(ODD)], "doc_id long, text string, ids int")
    docs = docs.unionByName(odd).coalesce(2)
    found = packing.pack(docs, "doc_id", "text", PATH, 1).collect()
    pieces, padding = _checked(found, packing.Limits())
    for r in docs.collect():
        parts = pieces[r["doc_id"]]
        assert [i for _, ids in parts for i in ids] == _ids(r["text"])
        assert [s for s, _ in parts] == [0, *np.cumsum([len(ids) for _, ids in parts])[:-1].tolist()]
    assert padding < 0.05


def test_compiled_words_are_the_tokenizer_s():
    tokenizer = packing.loaded(PATH)
    assert tokenizer.plain and tokenizer.by_word and tokenizer.compiled is not None
    rng = random.Random(3)
    letters = "abcdefABtsvrelmd'' ..,!1234\n\t éÀßÿ<|>$%"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(3000)] + ["", " ", "'", "x" * 5000, "ab " * 3000]
    assert sum(map(tokenizer.compiled.reads, texts)) == len(texts)
    for text, ids in zip(texts, tokenizer.encode(texts)):
        assert ids.tolist() == _ids(text)[:-1], text


def test_texts_that_are_not_latin_take_the_long_way(monkeypatch):
    texts = [t or "" for t in ODD] + ["日本 語 " * 400, "a 😀 b", "x\x85y"]
    monkeypatch.setattr(packing, "BLOCK", 20)
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    tokenizer = packing.WordTokenizer(PATH)
    assert [x.tolist() for x in tokenizer.encode(texts)] == [_ids(t)[:-1] for t in texts]


def test_another_tokenizer_is_read_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, library = packing.WordTokenizer(path), Tokenizer.from_file(path)
    assert not tokenizer.plain and not tokenizer.by_word and tokenizer.compiled is None
    texts = ["it's  a\n\ntest", "", "Ünïcödé 12"]
    assert [x.tolist() for x in tokenizer.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ties_repeated_rows_and_very_long_texts(spark):
    rows = [(1, "same words here")] * 50 + [(2, "word " * 9000), (2, "word " * 9000), (3, "x" * 40000)]
    found = packing.pack(spark.createDataFrame(rows, "k long, t string").coalesce(1), "k", "t", PATH, 1).collect()
    _, padding = _checked(found, packing.Limits())
    assert sum(r["length"] for r in found) == sum(len(_ids(t)) for _, t in rows)
    assert sum(r["start"] == 0 for r in found) == len(rows) and padding < 0.2


def test_limits_on_segments_and_loss(spark):
    rows = [(i, "some prompt words " * (i % 9), "answer " * (i % 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "k long, p string, t string").coalesce(1)
    limits = packing.Limits(tokens=100, segments=4, loss=60)
    found = packing.pack(docs, "k", "t", PATH, 1, limits, prompt="p").collect()
    pieces, padding = _checked(found, limits)
    for i, prompt, text in rows:
        assert [x for _, ids in pieces[i] for x in ids] == _ids(prompt)[:-1] + _ids(text)
    assert sum(r["loss_tokens"] for r in found) == sum(len(_ids(t)) for _, _, t in rows)
    assert padding < 0.25
    assert packing.pack(docs.limit(0), "k", "t", PATH, 1).count() == 0


def test_pipeline(spark, sf, monkeypatch):
    kept = {}
    keep = corpus_pipeline.materialise

    def watched(df, label):
        kept[label] = keep(df, label)
        return kept[label]

    monkeypatch.setattr(corpus_pipeline, "materialise", watched)
    whole = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, second, third, fourth = kept.values()
    toxic = {r["doc_id"] for r in queries.QUERIES["op4_toxicity"](spark, sf).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in docs.collect()} - toxic
    assert all(df.columns == docs.columns for df in kept.values())
    assert second.groupBy("text").count().where("count > 1").isEmpty()
    assert third.count() == second.count() and third.where("n_chars <> length(text)").count() == 0
    left = {r["doc_id"]: r["text"] for r in fourth.collect()}
    got = {}
    for r in whole:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {k: len(_ids(t)) for k, t in left.items()}
    one = next(r for r in whole if r["start"] == 0 and r["length"] == r["doc_tokens"])
    assert one["ids_crc32"] == zlib.crc32(np.array(_ids(left[one["doc_id"]]), "<u4").tobytes())
