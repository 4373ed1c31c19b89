"""Frequent and missing keys, broadcast and shuffled sides, forced on small rows."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ordertide.operators import (
    any_of, first_and_last, flag_exists, join_unique, latest, list_and_sum, lookup, lookup_many, priority_of,
    restrict_to, roll_up, shipment_star,
)
from ordertide.operators.rollups import max_date

def _events(spark):
    """A third of the rows share one key, a tenth have none, some rows are exact copies."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("k"), (n % 400).cast("string"))).alias("key"),
        (n % 7).alias("v"), F.when(n % 5 == 0, "Reject").when(n % 11 == 0, "Hold").otherwise("Pay").alias("state"),
        F.when(n % 4 != 0, F.timestamp_seconds(n * 1000)).alias("day"),
    )


def _side(spark):
    return spark.range(390).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.when(F.col("id") % 5 != 2, F.col("id") * 10).alias("w"),
    )


LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}


@pytest.fixture(params=[{}, LARGE], ids=["small", "large"])
def sides(spark, request):
    """Sides that Spark may broadcast, and sides that it must shuffle, with frequent keys split."""
    before = {key: spark.conf.get(key, None) for key in request.param}
    for key, value in request.param.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookups_with_frequent_and_missing_keys(spark, sides):
    left, side = _events(spark), _side(spark)
    left.createOrReplaceTempView("ev")
    side.createOrReplaceTempView("side")
    assert rows(join_unique(left, side, ["key"]).select("key", "v", "w")) == rows(
        spark.sql("SELECT key, v, (SELECT max(w) FROM side s WHERE s.key = e.key) w FROM ev e"))
    found = lookup(left, side, "key", {"w": "w"}, {"w": -1})
    many = lookup_many(left, ["key"], [side, side.select("key", (F.col("w") + 1).alias("x"))], {"x": 0})
    assert rows(found.select("key", "v", "w")) == rows(
        spark.sql("SELECT key, v, coalesce((SELECT max(w) FROM side s WHERE s.key = e.key), -1) w FROM ev e"))
    assert rows(many.select("key", "x")) == rows(
        spark.sql("SELECT key, coalesce((SELECT max(w) + 1 FROM side s WHERE s.key = e.key), 0) x FROM ev e"))
    known = "key IN (SELECT key FROM side)"
    assert rows(flag_exists(left, side, "key", "known").select("key", "known")) == rows(
        spark.sql(f"SELECT key, CASE WHEN {known} THEN 'Yes' ELSE 'No' END k FROM ev"))
    assert rows(restrict_to(left, side, "key").select("key", "v")) == rows(spark.sql(f"SELECT key, v FROM ev WHERE {known}"))


def test_rollups_on_large_groups(spark, sides):
    rules = {"any": any_of("state", "Hold"), "ranked": priority_of("state", ("Reject", "Missing"), "Pay", "On Hold"),
             "last": max_date("day")}
    _events(spark).createOrReplaceTempView("ev")
    wanted = spark.sql("""SELECT key, CASE WHEN key IS NULL THEN state WHEN bool_or(state = 'Hold') OVER w THEN 'Hold' ELSE state END a,
        CASE WHEN key IS NULL THEN state WHEN bool_or(state = 'Reject') OVER w THEN 'Reject'
             WHEN bool_or(state <> 'Pay') OVER w THEN 'On Hold' ELSE 'Pay' END r,
        CASE WHEN key IS NOT NULL THEN max(day) OVER w END l FROM ev WINDOW w AS (PARTITION BY key)""")
    assert rows(roll_up(_events(spark), "key", rules).select("key", *rules)) == rows(wanted)


def test_ties_kept_for_missing_and_frequent_keys(spark, sides):
    df = _events(spark)
    df.createOrReplaceTempView("ev")
    wanted = spark.sql("SELECT key, v, state FROM (SELECT *, dense_rank() OVER (PARTITION BY key ORDER BY v DESC) r FROM ev) WHERE r = 1")
    assert rows(latest(df, ["key"], ["v"], ties=True).select("key", "v", "state")) == rows(wanted)


def test_lists_and_sums_are_whole_for_any_size_and_layout(spark):
    n = F.col("id")
    df = spark.range(40_000).select(
        F.when(n % 8 > 2, "hot").otherwise(F.concat(F.lit("k"), (n % 50).cast("string"))).alias("key"), (n % 11).alias("v"))
    results = [
        rows(list_and_sum(df.repartition(parts), "key", {"values": "v"}, {"total": "v"})) for parts in (1, 3, 16)]
    assert results[0] == results[1] == results[2]
    hot = next(r for r in results[0] if r[0] == "hot")
    values = sorted(str(i % 11) for i in range(40_000) if i % 8 > 2)
    assert hot == ("hot", ", ".join(values), sum(map(int, values))) and len(results[0]) == len({r[0] for r in results[0]})


def test_first_and_last_skip_missing_moments(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 5, "y"), ("a", 9, "z"), ("b", None, "w")], "k string, m int, v string")
    assert rows(first_and_last(df, ["k"], ["m"], ["m", "v"])) == [("a", 3, 5, "y", 9, "z"), ("b", 1, None, "w", None, "w")]


def test_picks_and_repeated_keys(spark):
    left = spark.createDataFrame([("d",)], "k string")
    dim = spark.createDataFrame([("d", 1, "No"), ("d", 2, "Yes")], "k string, seq int, v string")
    for pick, value in (("first", "No"), ("last", "Yes")):
        assert rows(lookup(left, dim, "k", {"v": "v"}, pick=pick, seq=["seq"])) == [("d", value)]
    with pytest.raises(Exception, match="repeated k"):
        lookup(left, dim, "k", {"v": "v"}, pick="checked").collect()


def test_chained_lookups_read_every_input_once(spark, sides):
    left = spark.range(100).select(*[(F.col("id") % (7 + i)).alias(f"k{i}") for i in range(6)])
    for i in range(6):
        left = lookup(left, spark.range(20).select(F.col("id").alias(f"k{i}"), F.lit(i).alias("x")), f"k{i}", {f"v{i}": "x"})
    assert plan(left).count("Range (") == 7


def test_latest_prunes_before_the_shuffle(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(latest(lines, ["l_orderkey"], ["l_shipdate"]).select("l_orderkey", "l_shipdate"))
    assert "WindowGroupLimit" in text
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")  # printed top-down: one sits below the shuffle
    assert "l_comment" not in text and "l_tax" not in text


def test_rows_without_the_key_of_an_earlier_side_are_dealt_out(spark):
    """Most lines are of no batch. The side is grouped by batch, so Spark would neither shuffle it for the join nor split a partition."""
    n = F.col("id")
    lines = spark.range(4000).select(n.alias("line"), (n % 50).alias("ship"))
    terms = spark.range(3000).select(n.alias("line"), F.when(n % 5 == 0, F.concat(F.lit("b"), (n % 90).cast("string"))).alias("batch"))
    uploads = spark.range(500).select(F.when(n % 9 != 0, F.concat(F.lit("b"), (n % 80).cast("string"))).alias("batch"), n.alias("day"))
    telex = uploads.groupBy("batch").agg(F.max("day").alias("last"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        star = shipment_star(lines, {"terms": (["line"], terms), "telex": (["batch"], telex)}, ["ship", "line"])
        plain = lines.join(terms, "line", "left").join(telex, "batch", "left").select("batch", "line", "ship", "last")
        assert star.columns == plain.columns and rows(star) == rows(plain)
        parts = star.where("batch IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(r["count"] for r in parts) < 2 * 3400 / len(parts)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
