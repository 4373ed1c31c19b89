"""Decontamination, repeats and near duplicates against brute force."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from ordertide.llm import decontaminate, near_dedup, substrings
from ordertide.llm.words import plain_words

WORDS = [f"w{i}" for i in range(400)] + ["Ünï", "école", "the", "of"]


def _texts(rng, n, low=0, high=120):
    return [" ".join(rng.choices(WORDS, k=rng.randint(low, high))) for _ in range(n)]


def test_plain_words_match_the_pattern():
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text in ["Ab-c d9_É x\x85y", "", "ÀB", "a\x00b", " x"]:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert [w.decode() for w in plain_words(text.encode())] == pattern.findall(lower)
    assert plain_words(None) == []


def _hits(words, items, window):
    hit, found = set(), set()
    for item, text in items:
        own = [w.decode() for w in plain_words(text.encode())] if text else []
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            pattern = own[at:at + size]
            for i in range(len(words) - size + 1):
                if words[i:i + size] == pattern:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(hit), sorted(found)


@pytest.mark.parametrize("block", [800, 10**6])
def test_windows_found_as_by_brute_force(spark, block):
    rng = random.Random(1)
    texts = _texts(rng, 60)
    items = [(i, t) for i, t in enumerate(_texts(rng, 8, 5, 40))] + [(20, "w1"), (21, None), (22, ""), (23, "the of"), (23, "the of")]
    for i in range(0, 60, 3):
        cut = items[i % 8][1].split()
        start = rng.randint(0, max(0, len(cut) - 12))
        texts[i] += " " + " ".join(cut[start:start + 12]).upper() + " . " + texts[i][:30]
    texts += [None, "", texts[0], "the " * 50 + "of"]
    docs = spark.createDataFrame(list(enumerate(texts)), "d long, t string").withColumn("spans", F.lit("clash"))
    bench = spark.createDataFrame(items, "i long, t string")
    got = {r["id"]: r for r in decontaminate.contamination(docs, "d", "t", bench, "i", "t", 10, block).collect()}
    for i, text in enumerate(texts):
        words = [w.decode() for w in plain_words(text.encode())] if text else []
        n_hit, found = _hits(words, items, 10)
        spans = got[i]["spans"]
        assert (got[i]["n_words"], sum(spans[1::2]) - sum(spans[::2]), got[i]["items"]) == (len(words), n_hit, found)
    kept = {r["d"] for r in decontaminate.clean_rows(docs, bench, "i", "t", "t", 10, block).collect()}
    assert kept == {i for i in got if not got[i]["spans"]}
    assert decontaminate.contamination(docs, "d", "t", bench.limit(0), "i", "t").where(F.size("spans") > 0).count() == 0


def _removed(rows):
    """(n_removed, kept) by the rule itself."""
    lows = defaultdict(lambda: float("inf"))
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, words in split:
        for s in range(len(words) - 12):
            if i is not None:
                key = tuple(words[s:s + 13])
                lows[key] = min(lows[key], i)
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - 12):
            if i is not None and lows[tuple(words[s:s + 13])] < i:
                gone.update(range(s, s + 13))
        out.append((i, len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return out


def _repeating(rng):
    texts = _texts(rng, 120, 0, 90)
    passage = " ".join(rng.choices(WORDS, k=60))
    for i in range(0, 120, 4):
        cut = passage.split()[rng.randint(0, 30):][:rng.randint(10, 30)]
        texts[i] = f"{texts[i]} {' '.join(cut)}\t{texts[(i * 7) % 120]}"
    texts += [texts[3], texts[8], "\x0b".join(texts[8].split()), "a " * 40, "a " * 30, None, "", " \n"]
    rows = list(enumerate(texts, start=-4))
    return rows + [rows[8], (rows[12][0], texts[40] + " more"), (None, texts[8]), (None, None)]


@pytest.mark.parametrize("group", [4096, 1])
def test_repeats_removed_as_by_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    rows = _repeating(random.Random(2))
    docs = spark.createDataFrame(rows, "d long, t string").withColumns(
        {"kept": F.lit(1), "lost_id": F.lit("x"), "n": F.length("t")})
    got = substrings.cleaned(docs, "d", "t", "n").collect()
    plain = {(i, t): (n, kept) for (i, t), (_, n, kept) in zip(rows, _removed(rows))}
    want = sorted((repr(i), t if not plain[i, t][0] else plain[i, t][1]) if t is not None else (repr(i), "") for i, t in rows)
    assert sorted((repr(r["d"]), r["t"] or "") for r in got) == want
    assert docs.columns == list(got[0].asDict())
    assert all(r["n"] == (len(r["t"]) if r["t"] is not None else None) for r in got)
    assert substrings.cleaned(docs.limit(0), "d", "t", "n").count() == 0


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, start=1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_banded_alignment_is_exact_from_the_threshold_on():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.sample(range(1000), rng.randint(1, 60))
        b = list(a)
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(b)) if b else 0
            b[at:at + 1] = rng.choice([[], [rng.randrange(1000, 10**6)], [*b[at:at + 1], rng.randrange(1000, 10**6)]])
        b = list(dict.fromkeys(b))
        if not b:
            continue
        m = _lcs(a, b)
        exact = m / (len(a) + len(b) - m)
        found = near_dedup.similarity(np.array(a, np.uint64), np.array(b, np.uint64))
        assert found == pytest.approx(exact) if exact >= 0.8 else found <= exact + 1e-9


def test_alignment_of_repeated_shingles_is_exact():
    rng = random.Random(6)
    for kinds in (1, 2, 5, 30):
        for _ in range(150):
            a = [rng.randrange(kinds) for _ in range(rng.randint(1, 150))]
            b = a[rng.choice([0, 0, 1, 5]):] or [0]
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(b))
                b[at:at + 1] = rng.choice([[], [1000], [*b[at:at + 1], rng.randrange(kinds)]])
                b = b or [0]
            m = _lcs(a, b)
            exact = m / (len(a) + len(b) - m)
            found = near_dedup.similarity(np.array(a, np.uint64), np.array(b, np.uint64))
            assert found == pytest.approx(exact) if exact >= 0.8 else found <= exact + 1e-9


def _paged(rng, pages):
    header = [f"h{i}" for i in range(20)]
    return [header + [f"own{rng.randrange(10**6)}" for _ in range(80)] for _ in range(pages)]


def test_text_without_its_first_header_is_a_near_duplicate(spark):
    whole = [w for page in _paged(random.Random(7), 20) for w in page]
    texts = [" ".join(whole), " ".join(whole[20:]), " ".join(w for p in _paged(random.Random(8), 20) for w in p)]
    df = spark.createDataFrame(list(enumerate(texts)), "d long, t string")
    assert {r["id"]: r["class"] for r in near_dedup.classes(df, "d", "t").collect()} == {0: 0, 1: 0, 2: 2}


def test_short_texts_are_all_compared(spark):
    rng = random.Random(9)
    texts = []
    for i in range(150):
        words = [f"s{i}x{j}" if j % 3 else f"common{j}" for j in range(rng.choice([5, 8, 9, 10, 14, 19, 44, 50]))]
        own = list(words)
        if rng.random() < 0.5:  # as many words more as the threshold allows, on either side
            more = int(len(words) / 0.8 + 1e-9) - len(words)
            own = [*[f"m{i}y{j}" for j in range(more)], *words] if rng.random() < 0.5 else [*words, *[f"m{i}y{j}" for j in range(more)]]
        else:  # as many words changed as the threshold allows, spread over the text
            changed = int(len(words) / 9 + 1e-9)
            for j in range(changed):
                own[j * len(words) // changed] = f"m{i}y{j}"
        texts += [words, own]
    hasher = near_dedup.WordHasher()
    seq = [hasher([w.encode() for w in x]) for x in texts]
    assert all(near_dedup.similarity(a, b) >= 0.8 for a, b in zip(seq[::2], seq[1::2]))
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "d long, t string")
    assert {r["id"]: r["class"] for r in near_dedup.classes(df, "d", "t").collect()} == {i: i - i % 2 for i in range(300)}


def test_similar_texts_are_found_among_many_that_share_all_their_passages(spark):
    """Every run of words but those around single changes is in 256 texts; only texts with the same four passages are similar."""
    rng = random.Random(5)
    head, passages = [f"p{i}" for i in range(20)], [[[f"b{k}{v}x{i}" for i in range(60)] for v in range(2)] for k in range(4)]
    rows = []
    for i in range(512):
        words = head + [w for k in range(4) for w in passages[k][i % 16 >> k & 1]]
        words[rng.randrange(len(words))] = f"own{i}"
        rows.append((i, " ".join(words)))
    found = {r["id"]: r["class"] for r in near_dedup.classes(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()}
    assert found == {i: i % 16 for i in range(512)}


def test_short_similar_texts_are_found_among_many_that_share_their_rarest_words(spark):
    rows = [(i, " ".join([f"c{x}" for x in range(12)] + [f"s{i % 40}x{x}" for x in range(8)] + [f"own{i}"])) for i in range(80)]
    found = {r["id"]: r["class"] for r in near_dedup.classes(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()}
    assert found == {i: i % 40 for i in range(80)}


def _exact_classes(texts):
    """Class of each id by comparing all pairs, with an alignment of the words."""
    hasher = near_dedup.WordHasher()
    seq = {i: hasher((t or "").encode().split()) for i, t in texts}
    label = {i: i for i in seq}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in seq:
        for b in seq:
            if a < b and root(a) != root(b) and near_dedup.similarity(seq[a], seq[b]) >= 0.8:
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: root(i) for i in seq}


def _edited(rng, words, most):
    own = list(words)
    for _ in range(rng.randint(0, most)):
        at = rng.randrange(len(own))
        own[at:at + 1] = rng.choice([[f"new{rng.randrange(10**6)}"], [], [own[at], f"new{rng.randrange(10**6)}"]])
    return own


def test_near_duplicates_as_by_brute_force(spark):
    rng = random.Random(4)
    base = _texts(rng, 12, 60, 120)
    rows = [" ".join(_edited(rng, t.split(), 4)) for t in base for _ in range(6)]
    rows += [base[0], base[0], None, "", "one two", "one two", "one two three four"]
    rng.shuffle(rows)
    rows = [(i * 3 - 7, t) for i, t in enumerate(rows)]
    label = _exact_classes(rows)
    df = spark.createDataFrame([*rows, rows[3], (None, base[0]), (None, None)], "d long, t string").withColumn("stays", F.lit(1))
    got = {r["id"]: r["class"] for r in near_dedup.classes(df, "d", "t").collect()}
    assert got == label
    kept = [r["d"] for r in near_dedup.first_of_each(df, "d", "t").collect()]
    assert sorted(map(repr, kept)) == sorted(map(repr, [*set(label.values()), None, None]))
    assert near_dedup.classes(df.limit(0), "d", "t").count() == 0


def test_a_passage_that_many_share_is_no_group_of_pairs(spark, monkeypatch):
    """Texts with a common passage are not compared with each other, and near copies among them are found."""
    rng = random.Random(12)
    passage = [f"p{j}" for j in range(60)]
    texts = []
    for i in range(400):
        own = [f"o{i}x{j}" for j in range(90)]
        at = rng.randrange(90)
        texts.append(own[:at] + passage + own[at:])
    copies = [_edited(rng, texts[i], 6) for i in range(0, 400, 10)]
    rows = [(i, " ".join(x)) for i, x in enumerate(texts + copies)]
    compared = []
    whole = near_dedup._all_between
    monkeypatch.setattr(near_dedup, "_all_between", lambda placed, met: compared.append(whole(placed, met).count()) or whole(placed, met))
    found = {r["id"]: r["class"] for r in near_dedup.classes(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()}
    assert {i: c for i, c in found.items() if i < 400} == {i: i for i in range(400)}
    assert sum(found[400 + n] == 10 * n for n in range(40)) >= 38
    assert sum(compared) < 440 * near_dedup.FEW


@pytest.mark.parametrize("direct", [0, near_dedup.DIRECT])
def test_texts_with_half_a_passage_in_common_are_no_rows_of_pairs(spark, monkeypatch, direct):
    """200 texts share 120 of 180 words, which every run filter must let pass; only each tenth is similar to another."""
    passage, rows = [f"p{i}" for i in range(120)], []
    for i in range(200):
        own = passage + [f"o{i}x{k}" for k in range(60)]
        rows.append((i, " ".join(own)))
        if i % 10 == 9:
            rows.append((i + 1000, " ".join(own[:172] + ["new"] * 6)))
    listed, whole = [], near_dedup._rest

    def counted(*args):
        out = whole(*args)
        listed.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "_rest", counted)
    monkeypatch.setattr(near_dedup, "DIRECT", direct)
    found = {r["id"]: r["class"] for r in near_dedup.classes(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()}
    assert found == {i: i % 1000 for i, _ in rows}
    assert sum(listed) <= 200


def test_outlines_leave_out_no_similar_text():
    rng = np.random.default_rng(5)
    texts, base = [], rng.integers(0, 300, 700)
    for i in range(160):
        n = int(rng.integers(51, 700))
        words = base[:n].copy()
        at = rng.integers(0, n, int(n * rng.uniform(0, 0.2)))
        words[at] = rng.integers(0, 10**6, len(at))
        texts.append([f"w{w}".encode() for w in words[:n - int(rng.integers(0, 9))]])
    hasher = near_dedup.WordHasher()
    packed = [zstandard.compress(b" ".join(t)) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(packed, pa.binary())], names=["id", "packed"])
    outlines = next(near_dedup._outlined(iter([batch])))
    sides = [[r["id"], r["id"] % 7, r["words"], r["outline"]] for r in outlines.to_pylist()]
    names = ["one", "two", "side", "id", "class", "words", "outline"]

    def pairs(rows, size):
        table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows])
        found = [(p["a"], p["b"]) for out in near_dedup._paired(iter(table.to_batches(max_chunksize=size))) for p in out.to_pylist()]
        return {(a, b) for a, b in found if a < b}

    within = pairs([(0, 0, 0, *row) for row in sides], 7)
    blocks = pairs([(0, 0, 0, *r) for r in sides[:70]] + [(0, 1, 0, *r) for r in sides[:70]] + [(0, 1, 1, *r) for r in sides[70:]]
                   + [(1, 1, 0, *r) for r in sides[70:]], 33)
    seq = [hasher(t) for t in texts]
    similar = {(a, b) for a in range(160) for b in range(a + 1, 160) if a % 7 != b % 7 and near_dedup.similarity(seq[a], seq[b]) >= 0.8}
    assert len(similar) > 100 and similar <= within == blocks and len(within) < 160 * 159 / 4


def test_recall_on_the_documents(spark):
    """Of all pairs of different texts that are similar, found by a search of all shingles, 95 in 100 share a class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r["id"]: r["class"] for r in near_dedup.classes(docs, "doc_id", "text").collect()}
    hasher, holders, seq = near_dedup.WordHasher(10**7), defaultdict(set), {}
    for r in docs.collect():
        seq[r["doc_id"]] = hasher((r["text"] or "").encode().split())
        for w in np.unique(near_dedup.shingles(seq[r["doc_id"]], 3)).tolist():
            holders[w].add(r["doc_id"])
    pairs = Counter((a, b) for ids in holders.values() if len(ids) > 1 for a in ids for b in ids if a < b)
    similar = [(a, b) for (a, b), n in pairs.items() if 8 * n >= min(len(seq[a]), len(seq[b])) and near_dedup.similarity(seq[a], seq[b]) >= 0.8]
    assert len(similar) > 50
    assert sum(found[a] == found[b] for a, b in similar) >= 0.95 * len(similar)
    together = defaultdict(list)
    for one, label in found.items():
        together[label].append(one)
    for ids in together.values():  # nobody is in a class without someone similar
        for a in ids if len(ids) > 1 else ():
            assert any(near_dedup.similarity(seq[a], seq[b]) >= 0.8 for b in ids if a != b)


def test_long_texts_are_compared_whole(spark):
    rng = random.Random(13)
    words = [f"w{rng.randrange(3000)}" for _ in range(30000)]
    texts = [words, _edited(rng, words, 900), [*words[:15000], *[f"z{j}" for j in range(15000)]]]
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "d long, t string")
    assert {r["id"]: r["class"] for r in near_dedup.classes(df, "d", "t").collect()} == {0: 0, 1: 0, 2: 2}


def test_components_of_long_chains(spark):
    members = spark.range(60).select("id")
    links = spark.range(49).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    got = {r["id"]: r["class"] for r in near_dedup.components(members, links).collect()}
    assert got == {i: 0 if i < 50 else i for i in range(60)}


def test_clean_rows_searches_one_block_at_a_time(spark):
    docs = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(6)], "d long, text string")
    bench = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(4)], "i long, t string").coalesce(1)
    out = decontaminate.clean_rows(docs, bench, "i", "t", block_bytes=1)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["d"] for r in out.collect()) == [4, 5]


def test_a_block_at_its_limit_is_bounded():
    """The tables of as many benchmark bytes as one block may hold, of words that mostly differ."""
    rng = random.Random(14)
    text, size = [], 0
    while size < decontaminate.BLOCK_BYTES // 8:  # an eighth, so that the test is quick
        text.append(f"w{rng.randrange(200000)}".encode())
        size += len(text[-1]) + 1
    tracemalloc.start()
    tables = decontaminate.pattern_tables([("item", b" ".join(text))], decontaminate.WINDOW)
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert tables and used * 8 < 300 * 2**20
