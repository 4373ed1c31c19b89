"""Rows stored with numbers, and what is found for them beside them."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ordertide.operators import RowTables, lookup_many, shipment_star
from ordertide.operators.row_tables import stored_star
from ordertide.plans.status import attach_stage_days
from ordertide.plans.status.report import STAGE, at_current_stage
from ordertide.session import drop_staged


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _lines(spark):
    data = [("a", 1, "x"), ("a", 1, "x"), ("b", None, "y"), (None, 2, "y"), ("c", 3, None), ("z", 3, "x")]
    return spark.createDataFrame(data * 3, "k string, n int, g string")


def _groups(spark):
    by_k = spark.createDataFrame([("a", "A", "g1"), ("b", None, "g2"), ("z", "Z", None)], "k string, up string, found string")
    by_n = spark.createDataFrame([(1, "one"), (3, "three")], "n int, word string")
    by_found = spark.createDataFrame([("g1", "first")], "found string, more string")
    return [(["k"], [by_k]), (["n"], [by_n]), (["found"], [by_found])]


def test_steps_find_what_lookups_find_and_whole_rows_are_not_moved_for_it(spark, tmp_path, shuffled):
    defaults, plain = {"up": "none", "more": "-"}, _lines(spark)
    for keys, sides in _groups(spark):
        plain = lookup_many(plain, keys, sides, defaults)
    stored = RowTables(_lines(spark), str(tmp_path), derived={"both": F.concat("k", "g")})
    for group in _groups(spark):
        stored.look_up([group], defaults)
    read = stored.read()
    assert rows(read.select(*plain.columns)) == rows(plain)
    assert "Exchange" not in plan(read) and "Bucketed: true" in plan(read)
    assert "both" in read.columns and rows(stored.read(["word"]).select("word")) == rows(plain.select("word"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged")]
    assert drop_staged(spark, str(tmp_path)) and not list(tmp_path.iterdir())


def test_a_later_find_counts_and_no_rows_are_no_problem(spark, tmp_path):
    stored = RowTables(_lines(spark), str(tmp_path))
    stored.add(stored.read(["g"]).withColumn("g", F.coalesce("g", F.lit("none"))), dealt=True)
    assert rows(stored.read(["g"]).select("g").distinct()) == [("none",), ("x",), ("y",)]
    empty = RowTables(_lines(spark).where("n > 99"), str(tmp_path))
    empty.look_up(_groups(spark))
    assert empty.read().count() == 0 and "word" in empty.read().columns


def test_a_stored_star_is_the_star(spark, tmp_path, shuffled):
    n = F.col("id")
    lines = spark.range(400).select(n.alias("line"), (n % 50).alias("ship"))
    terms = spark.range(300).select(n.alias("line"), F.when(n % 5 == 0, F.concat(F.lit("b"), (n % 90).cast("string"))).alias("batch"))
    telex = spark.range(60).select(F.concat(F.lit("b"), n.cast("string")).alias("batch"), n.alias("last"))
    sides = {"terms": (["line"], terms), "telex": ("batch", telex)}
    names = ["line", "ship", "batch", "last"]
    assert rows(stored_star(lines, sides, str(tmp_path)).select(*names)) == rows(shipment_star(lines, sides).select(*names))


def test_only_rows_of_the_current_stage_are_moved_to_the_lines(spark):
    report = spark.createDataFrame([("p1", "03"), ("p1", "C"), ("p2", "11"), ("p3", None), ("p2", "11")], "line_key string, status_code string")
    dates = spark.createDataFrame([("p1", 5), ("p1", 6), ("p2", 7), ("p4", 8)], "po_id string, d int")
    numbers = F.explode(F.array(*[F.lit(str(i)) for i in range(1, 32)])).alias("stage_id")
    whole = dates.select("po_id", "d", numbers).select("po_id", "stage_id", (F.col("d") * 100 + F.col("stage_id").cast("int")).alias("delay_days"))
    some = at_current_stage(dates, report).select("po_id", "d", STAGE, numbers).where(F.col("stage_id") == F.col(STAGE))
    some = some.select("po_id", "stage_id", (F.col("d") * 100 + F.col("stage_id").cast("int")).alias("delay_days"))
    assert some.count() == 3 and rows(attach_stage_days(report, some)) == rows(attach_stage_days(report, whole))
