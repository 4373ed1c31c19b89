"""Chat formatting and sharding against plain Python."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from ordertide.llm import chat, shards

NODES = "conv_id long, node_id long, parent_id long, role string, text string, score double, tree string"


def test_best_paths_of_reply_trees(spark):
    nodes = [
        (1, 1, None, "user", "a", 0.0, "x"), (1, 2, 1, "assistant", "b", 1.0, "x"), (1, 3, 1, "assistant", "c", 3.0, "x"),
        (1, 4, 2, "user", "d", 5.0, "x"), (1, 5, 3, "user", None, None, "x"), (1, 6, 4, "assistant", "e</turn>\\#", -1.0, "x"),
        (2, 1, 9, None, None, None, "x"),  # the parent does not exist
        (None, 1, None, "user", "n", 0.0, "x"),
        (3, 1, 2, "user", "loop", 0.0, "x"), (3, 2, 1, "user", "loop", 0.0, "x"),  # a cycle has no root
        (4, 1, None, "user", "same", 0.0, "x"), (4, 1, None, "user", "same", 0.0, "x"),  # a repeated row
    ]
    df = spark.createDataFrame(nodes, NODES)
    found = chat.read_back(chat.format_chats(df, best=2)).collect()
    paths = {(r["conv_id"], r["path_rank"]): [(t["role"], t["text"]) for t in r["turns"]] for r in found}
    assert paths == {
        (1, 1): [("user", "a"), ("assistant", "b"), ("user", "d"), ("assistant", "e</turn>\\#")],
        (1, 2): [("user", "a"), ("assistant", "c"), ("user", "")],
        (2, 1): [("", "")], (None, 1): [("user", "n")], (4, 1): [("user", "same")],
    }
    loss = {(r["conv_id"], r["path_rank"]): r["loss_text"] for r in found}
    assert loss[1, 1] == "be</turn>\\#" and loss[2, 1] == ""


def test_random_trees_as_by_walking_up(spark):
    rng = random.Random(11)
    nodes = []
    for tree in range(30):
        for node in range(1, rng.randint(2, 60)):
            parent = rng.choice([None, 0, node - 1, rng.randrange(node)]) if node > 1 else None
            nodes.append((tree, node, parent, "user", f"{tree}-{node}", float(rng.randrange(-3, 4)), "x"))
    nodes += [(99, n, n - 1 if n > 1 else None, "user", f"99-{n}", 1.0, "x") for n in range(1, 200)]  # a long thread ...
    nodes += [(99, 1000 + n, n, "user", f"99-{1000 + n}", float(n % 7), "x") for n in range(1, 200)]  # ... with a leaf at each turn
    up = {(t, n): p for t, n, p, *_ in nodes}
    score = {(t, n): s for t, n, _, _, _, s, _ in nodes}
    parents = {(t, p) for t, _, p, *_ in nodes}
    want = {}
    for tree in {t for t, *_ in nodes}:
        found = []
        for leaf in [n for t, n, *_ in nodes if t == tree and (t, n) not in parents]:
            path, at = [], leaf
            while (tree, at) in up:
                path.append(at)
                at = up[tree, at]
            found.append((-sum(score[tree, n] for n in path), -len(path), leaf, path[::-1]))
        for place, (_, _, _, path) in enumerate(sorted(found)[:3], start=1):
            want[tree, place] = [f"{tree}-{n}" for n in path]
    got = chat.read_back(chat.format_chats(spark.createDataFrame(nodes, NODES), best=3)).collect()
    assert {(r["conv_id"], r["path_rank"]): [t["text"] for t in r["turns"]] for r in got} == want


def test_control_strings_come_back(spark):
    texts = ["\\### Assistant: </turn> ok", "\\b\\h\\l", "### user: ", "</turn>\n", "", "\\", "ünï\n\n<#>"]
    rows = [(7, i, "assistant" if i % 2 else "us: er#", t, None, None) for i, t in enumerate(texts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, node_id string")
    got = chat.read_back(chat.format_chats(chat.chain_nodes(turns))).first()
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r[2], r[3]) for r in rows]
    assert got["loss_text"] == "".join(r[3] for r in rows if r[2] == "assistant")
    assert chat.format_chats(chat.chain_nodes(turns.limit(0))).count() == 0


def test_long_chain(spark):
    turns = spark.range(300).select(
        F.lit(1).alias("conv_id"), (300 - F.col("id")).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.read_back(chat.format_chats(chat.chain_nodes(turns))).first()
    assert [t["text"] for t in got["turns"]] == [str(i) for i in range(299, -1, -1)]


def _expected_shards(rows, limit):
    """Buckets by splitting each that is too large on one more bit."""
    hashed = [(int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16), k, len((t or "").encode())) for k, t in rows]
    out, waiting = {}, [(0, "", hashed)]
    while waiting:
        depth, name, part = waiting.pop()
        if sum(x[2] for x in part) <= limit:
            out.update({x[1]: name for x in part})
            continue
        for bit in "01":
            waiting.append((depth + 1, name + bit, [x for x in part if (x[0] >> (59 - depth)) & 1 == int(bit)]))
    return out


def test_shards_split_only_where_too_large(spark):
    rows = [(i, "é" * (i % 40)) for i in range(2000)] + [(5000, None), (5001, "")]
    df = spark.createDataFrame(rows, "k long, t string").withColumns({"key": F.lit(1), "shard": F.lit("clash")})
    got = {r["key"]: r["shard"] for r in shards.shards(df, "k", "t", 200).collect()}
    assert got == _expected_shards(rows, 200)


def test_one_key_of_a_third_of_all_rows_still_fits(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("x" * 10).alias("t"))
    rows = rows.union(spark.createDataFrame([(None, "y" * 300)], "k long, t string"))
    got = shards.shards(rows, "k", "t", 100).collect()
    assert len(got) == 901
    sums = defaultdict(int)
    for r in got:
        sums[r["shard"]] += r["bytes"]
    over = {r["shard"] for r in got if r["oversize"]}
    assert all(v <= 100 for s, v in sums.items() if s not in over) and [sums[s] for s in over] == [300]
    assert all(sums[r["shard"]] == r["shard_bytes"] for r in got)
    assert shards.shards(rows.limit(0), "k", "t", 100).count() == 0


def test_shards_are_written(spark, tmp_path):
    df = spark.range(200).select(F.col("id").alias("k"), F.lit("abc").alias("t"), F.lit("own").alias("shard"))
    shards.write_shards(df, "k", "t", 60, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 1
    assert back.groupBy("shard_").count().agg(F.max("count")).first()[0] <= 20


def test_written_shards_hold_what_was_assigned(spark, tmp_path):
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"), F.lit("x" * 10).alias("t"))
    rows = rows.union(spark.range(40).select(F.lit(None).cast("long"), F.lit("y" * 10)))
    placed = shards.write_shards(rows, "k", "t", 100, str(tmp_path / "out"))
    assert placed.columns == list(shards.COLUMNS)
    back = spark.read.parquet(str(tmp_path / "out"))
    found = {r["shard"]: (r["n"], r["b"]) for r in back.groupBy("shard").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("b")).collect()}
    assert found == {"s" + r["shard"]: (r["shard_rows"], r["shard_bytes"]) for r in placed.distinct().collect()}
    assert back.count() == 340 and back.where("k IS NULL").count() == 40 and back.where("k = -1").count() == 100
    assert max(b for _, b in found.values()) <= 100
