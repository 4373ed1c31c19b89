"""Lookups and roll-ups that move row numbers and keys instead of whole rows."""

from pyspark.sql import functions as F

from helpers import plan, rows
from ordertide.operators import any_of, lookup_by_row, lookup_many, roll_up_all
from ordertide.session import staged


def _lines(spark, tmp_path):
    data = [("a", 1, "x", "Open"), ("a", 1, "x", "Hold"), ("b", None, "y", "Open"), (None, 2, "y", None), ("c", 3, None, "Hold"), ("a", 1, "x", "Open")]
    df = spark.createDataFrame(data, "k string, n int, g string, state string").withColumn("_row", F.monotonically_increasing_id())
    return staged(df, str(tmp_path))


def _groups(spark):
    by_k = spark.createDataFrame([("a", "A", "g1"), ("b", None, "g2"), ("z", "Z", "g3")], "k string, up string, found string")
    by_n = spark.createDataFrame([(1, "one"), (3, "three")], "n int, word string")
    by_found = spark.createDataFrame([("g1", "first")], "found string, more string")
    return [(["k"], [by_k]), (["n"], [by_n]), (["found"], [by_found])]


def test_lookup_by_row_finds_what_lookup_many_finds(spark, tmp_path):
    lines, defaults = _lines(spark, tmp_path), {"up": "none", "more": "-"}
    plain = lines
    for keys, sides in _groups(spark):
        plain = lookup_many(plain, keys, sides, defaults)
    found = lookup_by_row(lines, "_row", _groups(spark), defaults)
    assert found.columns == plain.columns and rows(found) == rows(plain)


def test_lines_are_moved_by_number_only(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup_by_row(_lines(spark, tmp_path), "_row", _groups(spark)[:2])
        shuffled = [line for line in plan(found.select("k", "n", "state", "up", "word")).splitlines() if "Exchange hashpartitioning" in line]
        assert sum("hashpartitioning(_row" in line for line in shuffled) == 3  # the lines once, and what each key found
        rolled = roll_up_all(_lines(spark, tmp_path), {"k": {"b": any_of("state", "Hold")}, "g": {"s": any_of("state", "Hold")}}, "_row")
        assert sum("hashpartitioning(_row" in line for line in plan(rolled).splitlines()) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_roll_ups_by_row_number_are_the_same(spark, tmp_path):
    lines = _lines(spark, tmp_path)
    rules = {"k": {"b": any_of("state", "Hold")}, "g": {"s": any_of("state", "Hold")}}
    by_number, plain = roll_up_all(lines, rules, "_row"), roll_up_all(lines, rules)
    assert by_number.columns == plain.columns and rows(by_number) == rows(plain)
