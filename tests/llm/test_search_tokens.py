"""Ranked search, token counts and token alignment against plain versions of their rules."""

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ordertide.llm import alignment, queries, ranked_search, transducer

PATH_A, PATH_B = (public_tokenizers.path(n) for n in (queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER))
ODD = [
    None, "", " ", "\n\n", "a", "'", "'r", "'re", "''re", "x'rea 'll'l", "   a", "\n\n a \t b", "a" * 3000, "-" * 700 + " " * 900 + "x",
    "<|endoftext|>", " <|endoftext|>a<|endoftext|><|endoftext|> ", "<s> </s> <unk>", "▁a ▁▁ b", "\x00 \x1c\x85  x", "日本語 naïve 😀😀 é ½² ǅ",
]


def _texts(seed, n):
    rng = random.Random(seed)
    near = "ab'srevlltdm  \n\t1 2!.é日 ́²😀’"
    wide = lambda: chr(rng.choice([rng.randrange(1, 0x3000), rng.randrange(0xE000, 0xFFFF), rng.randrange(0x10000, 0x1FFFF)]))
    out = ["".join(rng.choice(near) for _ in range(rng.randrange(80))) for _ in range(n)]
    return out + ["".join(wide() for _ in range(40)) for _ in range(n // 10)]


# Ranked search


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def _ranked(docs, items, k):
    held = [(one, Counter(_words(t))) for one, t in docs]
    held = [(one, c, sum(c.values())) for one, c in held if c]
    n_docs, terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for one, counts, n in held:
            m = 100 - 75 + (75 * n * n_docs) // terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in _words(text) if t in counts)
            if score > 0:
                found.append((-score, math.inf if one is None else one))
        out += [(item, rank, None if one == math.inf else one, -score) for rank, (score, one) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def _searched(spark, docs, items, k, **how):
    docs = spark.createDataFrame([(a, b, 1) for a, b in docs], "id long, text string, m int")
    items = spark.createDataFrame([(a, b, "x") for a, b in items], "item string, text string, term string")
    blocks = {n: how.pop(n) for n in list(how) if n.startswith("block")}
    index = ranked_search.build_index(docs, "id", "text", **blocks)
    return sorted((tuple(r) for r in ranked_search.search(index, items, "item", "text", k, **how).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"block_documents": 7, "first": 1}, {"block_words": 50, "query_bytes": 200, "first": 3}])
def test_search_as_by_brute_force(spark, how):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "OF", "é", "日本"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=n))
    docs = [(i, text(rng.choice([1, 3, 8, 8, 8, 8, 40, 200]))) for i in range(300)]
    docs += [(900 + i, docs[3][1]) for i in range(150)]  # a third are copies, all ties
    docs += [(7, docs[7][1]), (7, docs[7][1]), (None, docs[9][1]), (None, None), (400, None), (401, ""), (402, "?! --"), (403, "w1 " * 5000)]
    items = [(f"i{i}", text(rng.randrange(1, 30))) for i in range(20)]
    items += [("none", None), ("blank", "..."), ("away", "unknown words"), ("i0", "w1 w1 the The"), (None, "w2 é"), ("copies", docs[3][1])]
    assert _searched(spark, docs, items, 10, **how) == _ranked(docs, items, 10)


def test_search_of_empty_tables(spark):
    assert _searched(spark, [], [("a", "b")], 3) == []
    assert _searched(spark, [(1, None), (2, "")], [("a", "b")], 3) == []
    assert _searched(spark, [(1, "b")], [], 3) == []


def test_late_strata_are_visited_only_where_they_can_win():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pylist(
        [{"m": 100, "block": 0, "term": None, "tfs": [], "ends": [], "docs": [5, 6]},
         {"m": 100, "block": 0, "term": "a", "tfs": [2, 1], "ends": [1, 2], "docs": [1, 0]}])
    one = ranked_search.Queries(["q"], {"a": (np.array([0]), np.array([3]))})
    best = 3 * int(ranked_search.impact(np.int64(2), 100))
    for floor, found in ((best, [6]), (best + 1, [])):
        visits = ranked_search.Visits(one, 2, np.array([floor]))
        visits.block(100, [rows], np.array([True]))
        assert visits.rows().column(1).to_pylist() == found


# Token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH_A)


@pytest.fixture(scope="module")
def machine():
    return transducer.CompiledTokenizer(PATH_A, transducer.character_classes(PATH_A))


def test_counts_are_the_library_s(spark, library):
    texts = ODD + _texts(1, 1500)
    rows = [(i if i % 7 else None, t, 0) for i, t in enumerate(texts)]
    found = transducer.token_counts(spark.createDataFrame(rows, "key long, text string, n_tokens int"), "key", "text", PATH_A)
    wanted = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(wanted, key=repr)


def test_counts_of_all_documents(spark, sf, library):
    found = {r["doc_id"]: r for r in queries.token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(found)
    for doc in docs:
        n = len(library.encode(doc["text"] or "", add_special_tokens=False).ids)
        assert (found[doc["doc_id"]]["n_tokens"], found[doc["doc_id"]]["over_limit"]) == (n, n > 1024)


def test_states_may_be_dropped_and_texts_cut_anywhere(machine, library, monkeypatch):
    texts = [t or "" for t in ODD] + _texts(2, 300) + ["word after word, it's 1 text " * 40]
    wanted = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(transducer, "PART", 64)
    monkeypatch.setattr(transducer, "CHUNK", 16)
    monkeypatch.setattr(machine.counter, "most", 50)
    assert list(machine.counts(texts)) == wanted


def test_a_chunk_s_map_is_that_of_its_characters_one_by_one():
    rng = random.Random(4)
    symbols = np.array([rng.choice([0, 1, 2, 3, 3, 4, 5, 5, 6, 7, 8, 9, 10, 10, 11]) for _ in range(5000)], np.uint8)
    starts, state = set(), transducer.FRESH
    for i, kind in enumerate(symbols.tolist()):
        state, marks = transducer._step(state, kind)
        starts |= {i} if marks & transducer.HERE else set()
        starts |= {i - 1} if marks & transducer.BEFORE else set()
    assert transducer.word_starts(symbols).tolist() == sorted(starts)


def test_every_token_is_one_token(machine):
    merges = machine.counter.merges
    rng = random.Random(6)
    for token in rng.sample(merges.tokens, 3000):
        data = np.frombuffer(token, np.uint8)
        if 0xFF not in token:
            tokens, ends = machine.counter.token_ends(data, np.array([0]))
            assert [merges.tokens[t] for t in tokens] == [token] and ends.tolist() == [len(token) - 1]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        transducer.CompiledTokenizer(public_tokenizers.path("word_bpe_49k.json"), ())


# Alignment


def test_galloping_finds_what_is_common():
    rng = random.Random(8)
    for n in (0, 1, 2, 10, 200):
        for density in (0.05, 0.5, 0.95):
            a, b = (sorted(i for i in range(n) if rng.random() < d) for d in (density, 0.6))
            in_a, in_b = alignment.common_ends(np.array(a, int), np.array(b, int))
            common = sorted(set(a) & set(b))
            assert in_a.tolist() == [bisect_left(a, x) for x in common] and in_b.tolist() == [bisect_left(b, x) for x in common]


def _aligned(library_a, library_b, text):
    """[(ids of A, ids of B)] of each group, by the libraries' tokens and sets of ends."""
    if not text:
        return []
    letters = transducer.byte_letters()
    a = library_a.encode(" " + text, add_special_tokens=False)
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    bytes_a = [bytes(letters[c] for c in token) for token in a.tokens]
    ids_b = library_b.encode(text)
    pieces = [library_b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    groups, parts = [], [list(zip(a.ids, ends(bytes_a))), list(zip(ids_b, ends(bytes_b)))]
    low = 0
    for end in sorted(set(ends(bytes_a)) & set(ends(bytes_b))):
        groups.append(tuple([i for i, e in part if low < e <= end] for part in parts))
        low = end
    return groups


def _expected(library, texts):
    plain = Tokenizer.from_file(PATH_A)
    plain.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=PATH_B)
    groups = [_aligned(plain, pieces, t) for t in texts]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(pair for one in linked for pair in one)
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for g, one in zip(groups, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
            sum(n for (a, b), n in one.items() if counts[a, b] == highest[a]), sum(n * counts[p] for p, n in one.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


@pytest.mark.parametrize("broadcast", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_as_by_brute_force(spark, library, broadcast):
    texts = ODD + _texts(3, 300) + ["the same words again and again"] * 200 + ["x" * 5000, "日" * 2000 + "\n" * 999]
    rows = [(i % 900 if i % 11 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "key long, text string, pair int").repartition(5)
    found = alignment.scored(docs, "key", "text", PATH_A, PATH_B, queries.GroupsDigest(), broadcast)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "description"]
    found = sorted((r["id"], *(r[n] for n in names)) for r in found.na.fill(-1, ["id"]).collect())
    wanted = sorted((-1 if row[0] is None else row[0], *one) for row, one in zip(rows, _expected(library, texts)))
    assert found == wanted


def test_large_groups_are_paired_by_their_ids(monkeypatch):
    rng = np.random.default_rng(9)
    cuts = np.array([3, 40, 41, 90])
    one = alignment.Aligned(rng.integers(0, 6, 90), rng.integers(0, 5, 70), cuts, np.array([1, 30, 60, 70]))
    whole = alignment.linked_pairs(one, 100)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 10)
    for x, y in zip(whole, alignment.linked_pairs(one, 100)):
        assert x.tolist() == y.tolist()
    assert whole[1].sum() == one.links()


def test_alignment_of_all_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in queries.cross_alignment(spark, sf).collect()}
    wanted = _expected(library, [d["text"] for d in docs])
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [tuple(found[d["doc_id"]][n] for n in names) for d in docs] == wanted


def test_align_returns_ids_and_cuts(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, None)], "k long, t string")
    one, two = alignment.align(docs, "k", "t", PATH_A, PATH_B).orderBy("id").collect()
    assert len(one["a"]) == one["a_cut"][-1] and len(one["b"]) == one["b_cut"][-1] and two["a"] == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, t string")
    assert transducer.token_counts(none, "k", "t", PATH_A).collect() == []
    assert alignment.scored(none, "k", "t", PATH_A, PATH_B).where(F.col("n_a") > 0).count() == 0
