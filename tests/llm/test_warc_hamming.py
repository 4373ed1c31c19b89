"""Fixity audits and binary code search against plain Python."""

import random

from ordertide.llm import hamming, warc

RECORD = "file string, offset long, length long, digest string"


def _audit(spark, left, right):
    found = warc.audit(spark.createDataFrame(left, RECORD), spark.createDataFrame(right, RECORD)).collect()
    return sorted((r["file"] or "", r["offset"] if r["offset"] is not None else -1, r["status"]) for r in found)


def test_damage_is_located(spark):
    left = [(f"f{f}", i * 5000, 5000, f"d{f}-{i}") for f in range(3) for i in range(200)]
    right = list(left)
    right[7] = ("f0", 35000, 5000, "other")
    right[450] = ("f2", 250000, 4000, "short")
    del right[300]
    right += [("f9", 0, 10, "new"), left[3], (None, 1, 1, "lost")]
    assert _audit(spark, left, right) == sorted([
        ("f0", 35000, "changed"), ("f2", 250000, "resized"), ("f1", 500000, "missing"), ("f9", 0, "extra"),
        ("f0", 15000, "repeated"), ("", 1, "unplaced")])


def test_equal_and_empty_archives(spark):
    rows = [("f", 0, 1, None), ("f", 0, 1, None), ("g", 2**40, None, "x")]
    assert _audit(spark, rows, rows[::-1]) == []
    assert _audit(spark, [], []) == []
    assert _audit(spark, rows[:1], []) == [("f", 0, "missing")]


def test_descends_only_where_roots_differ(spark, monkeypatch):
    left = [(f"f{f}", i * 70000, 70000, f"d{f}-{i}") for f in range(20) for i in range(20)]
    right = [r if r[:2] != ("f4", 700000) else (*r[:3], "bad") for r in left]
    sizes = []
    keep = warc._differing

    def watched(a, b):
        sizes.append((a.count(), b.count()))
        return keep(a, b)

    monkeypatch.setattr(warc, "_differing", watched)
    assert _audit(spark, left, right) == [("f4", 700000, "changed")]
    assert sizes[0] == (20, 20) and all(max(s) <= 16 for s in sizes[1:])


def _codes(rng, n):
    base = [rng.getrandbits(64) for _ in range(8)]
    out = []
    for i in range(n):
        code = rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 3, 9])):
            code ^= 1 << rng.randrange(64)
        out.append((i, code - 2**64 if code >= 2**63 else code))
    return out


def test_top_k_is_exact_with_ties_and_copies(spark):
    rng = random.Random(3)
    rows = _codes(rng, 300) + [(900, None), (5, 77), (5, 77)]
    df = spark.createDataFrame(rows, "id long, code long")
    queries = df.where("id % 20 = 0 OR id = 5")
    got = sorted((r["query_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in hamming.top_k(df, queries, 4).collect())
    known = [r for r in rows if r[1] is not None]
    want = []
    for q, code in known:
        if q % 20 == 0 or q == 5:
            near = sorted((((code ^ c) & (2**64 - 1)).bit_count(), i) for i, c in known)[:4]
            want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_fewer_rows_than_k_and_none(spark):
    df = spark.createDataFrame([(1, 0), (2, -1)], "id long, code long")
    assert hamming.top_k(df, df, 10).count() == 4
    assert hamming.top_k(df.limit(0), df, 10).count() == 0
    assert hamming.top_k(df, df.limit(0), 10).count() == 0


def test_sign_code(spark):
    rows = [([1.0, -1.0, 0.0] + [None] * 3,), (None,), ([-1.0] * 63 + [2.0, 5.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert [r[0] for r in df.select(hamming.sign_code(df.v)).collect()] == [0b101, None, -(2**63)]
