"""Loads merged into a kept latest state, and group statuses taken for several keys at once."""

import random
import re
import tempfile

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from checks.status_tables import status_tables
from ordertide.operators import LatestState, all_of, any_of, latest, priority_of, roll_up_all
from ordertide.operators.rollups import max_date
from ordertide.plans.status.report import enrich, group_statuses

ORDER = ["at", "v"]


def _load(spark, rng, n, keys, start):
    data = [(f"k{rng.randrange(keys)}" if rng.random() > 0.05 else None, start + rng.randrange(50), rng.randrange(9)) for _ in range(n)]
    return spark.createDataFrame(data, "key string, at long, v long")


def test_merged_loads_give_the_latest_rows_of_all(spark):
    rng = random.Random(1)
    state = LatestState(tempfile.mkdtemp(prefix="state-"), ["key"], ORDER, buckets=8)
    with pytest.raises(FileNotFoundError):
        state.read(spark)
    every = None
    for load in (_load(spark, rng, 300, 80, 0), _load(spark, rng, 100, 120, 20), _load(spark, rng, 5, 500, 0), _load(spark, rng, 0, 1, 0)):
        state.merge(load)
        every = load if every is None else every.unionByName(load)
        assert rows(state.read(spark).select("key", "at", "v")) == rows(latest(every, ["key"], ORDER))
    state.merge(every)  # what has been merged before changes nothing
    assert rows(state.read(spark).select("key", "at", "v")) == rows(latest(every, ["key"], ORDER))
    assert state.prune(spark)
    assert rows(state.read(spark).select("key", "at", "v")) == rows(latest(every, ["key"], ORDER))


def test_a_merge_reads_only_the_buckets_it_touches(spark):
    state = LatestState(tempfile.mkdtemp(prefix="s-"), ["key"], ORDER, buckets=64)
    state.merge(spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("at"), F.lit(1).cast("long").alias("v")))
    folder = tempfile.mkdtemp(prefix="l-")
    spark.createDataFrame([("k7", 9000, 5), ("new", 1, 2)], "key string, at long, v long").write.mode("overwrite").parquet(folder)
    load = spark.read.parquet(folder)
    touched = state.touched(load)
    assert len(touched) <= 2
    text = plan(state.merged(load, touched))
    paths = re.findall(r"InMemoryFileIndex\((\d+) paths?\)", text)
    assert sorted(map(int, paths)) == sorted([1, len(touched)])
    before = set(state._places(spark).values())
    assert state.merge(load) == touched
    assert len(before & set(state._places(spark).values())) == 64 - len(touched)
    assert state.read(spark).where("key IN ('k7', 'new')").count() == 2
    assert state.read(spark, touched).count() < 200


def test_a_failed_merge_changes_nothing(spark):
    state = LatestState(tempfile.mkdtemp(prefix="state-"), ["key"], ORDER, buckets=4)
    state.merge(spark.createDataFrame([("a", 1, 1)], "key string, at long, v long"))
    bad = spark.range(10).select(F.concat(F.lit("b"), "id").alias("key"), F.col("id").alias("at"),
                                 F.when(F.col("id") == 9, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="broken"):
        state.merge(bad)
    assert rows(state.read(spark).select("key", "at", "v")) == [("a", 1, 1)]


def _groups(spark):
    n = F.col("id")
    return spark.range(3000).select(
        n.alias("n"), F.when(n % 10 != 1, F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), n % 200))).alias("batch"),
        F.when(n % 7 != 2, n % 50).alias("ship"), F.when(n % 5 == 0, "Reject").when(n % 11 == 0, "Hold").otherwise("Pay").alias("state"),
        F.when(n % 4 != 0, F.timestamp_seconds(n * 1000)).alias("day"))


def test_two_group_keys_at_once(spark):
    df = _groups(spark)
    df.createOrReplaceTempView("rolled")
    found = roll_up_all(df, {
        "batch": {"b_any": any_of("state", "Hold"), "b_all": all_of("state", "Pay", "Open"), "b_day": max_date("day")},
        "ship": {"s_rank": priority_of("state", ("Reject",), "Pay", "On Hold"), "s_any": any_of("state", "Hold")},
    })
    wanted = spark.sql("""
        SELECT n, CASE WHEN batch IS NOT NULL AND bool_or(state = 'Hold') OVER (PARTITION BY batch) THEN 'Hold' ELSE state END AS b_any,
          CASE WHEN batch IS NULL THEN state WHEN bool_and(state = 'Pay') OVER (PARTITION BY batch) THEN 'Pay' ELSE 'Open' END AS b_all,
          CASE WHEN batch IS NOT NULL THEN max(day) OVER (PARTITION BY batch) END AS b_day,
          CASE WHEN ship IS NULL THEN state WHEN bool_or(state = 'Reject') OVER (PARTITION BY ship) THEN 'Reject'
            WHEN bool_or(state <> 'Pay') OVER (PARTITION BY ship) THEN 'On Hold' ELSE 'Pay' END AS s_rank,
          CASE WHEN ship IS NOT NULL AND bool_or(state = 'Hold') OVER (PARTITION BY ship) THEN 'Hold' ELSE state END AS s_any
        FROM rolled""")
    assert rows(found.select(*wanted.columns)) == rows(wanted)
    assert [c for c in found.columns if c.startswith("_")] == [] and found.columns[:5] == df.columns


def test_the_groups_of_all_keys_are_one_grouping(spark, sf):
    tables = status_tables(spark, sf)
    lines = enrich(tables["lines"], tables)
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    once = text(lines).count("Relation [l_orderkey")
    assert once and text(group_statuses(lines, tables)).count("Relation [l_orderkey") <= 3 * once + 6
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Both joins use the result of one grouping: it is exchanged once and used again.
        grouped = roll_up_all(_groups(spark), {"batch": {"b": any_of("state", "Hold")}, "ship": {"s": any_of("state", "Hold")}})
        made = plan(grouped)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert made.count("Reused") == 1 and made.count("Generate explode") == 1
