"""Readers and writers on small files."""

import os
import tempfile
from datetime import date

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from checks.compare import compare, connect
from checks.file_queries import ORACLE as FILE_ORACLE
from checks.file_queries import QUERIES as FILES
from ordertide.operators import publish_view
from ordertide.session import drop_staged, staged
from ordertide.sources import (
    at_snapshot, clean_tracker, coerce_dates, conform, publish, read_mapping_csv, read_mapping_tabs,
    read_published, read_table, small_table, split_errors, write_csv, write_json, write_report,
)


def test_csv_mark_and_spaces_in_the_header(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_bytes("﻿Static PO List, Status\nPO1,Paid In Full\nPO2,\n".encode())
    df = read_mapping_csv(spark, str(path))
    assert df.columns == ["Static PO List", "Status"]
    assert rows(df) == [("PO1", "Paid In Full"), ("PO2", None)]


def test_tabs_from_csv_and_parquet(spark, tmp_path):
    (tmp_path / "memo.csv").write_text("a,b\n1,2\n")
    spark.range(2).write.parquet(str(tmp_path / "owners"))
    tabs = read_mapping_tabs(spark, str(tmp_path), ["memo", "owners"])
    assert rows(tabs["memo"]) == [("1", "2")] and tabs["owners"].count() == 2


def test_snapshot_prunes_partitions(spark, tmp_path):
    df = spark.range(6).withColumn("snapshot_date", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    df.write.partitionBy("snapshot_date").parquet(str(tmp_path / "tab"))
    found = at_snapshot(read_table(spark, str(tmp_path / "tab")), "2025-01-02")
    assert found.count() == 2 and "PartitionFilters: [isnotnull(snapshot_date" in plan(found)


def test_filters_and_columns_reach_the_scan(spark, sf):
    df = read_table(spark, f"{sf}/lineitem.parquet").where("l_quantity > 40").select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan(df)


def test_tracker_drops_blank_keys(spark):
    df = spark.createDataFrame([("a", "x", 1), (" ", "y", 2), (None, "z", 3)], "k string, v string, other int")
    assert rows(clean_tracker(df, "k", ["v"], {"w": F.upper("v")})) == [("a", "x", "X")]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "` po_id ` int")
    assert conform(df, ["po_id"]).columns == ["po_id"]
    with pytest.raises(ValueError, match="missing required columns"):
        conform(df, ["po_created_date"])


def test_unreadable_dates_become_missing(spark):
    df = spark.createDataFrame([("2025-01-02", date(2025, 1, 3)), ("soon", None)], "a string, b date")
    found = [(str(r.a), str(r.b)) for r in coerce_dates(df, ["a", "b", "absent"]).collect()]
    assert found == [("2025-01-02 00:00:00", "2025-01-03 00:00:00"), ("None", "None")]


def test_errors_are_set_apart(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", -1)], "id string, n int")
    good, bad = split_errors(df, {"no number": F.col("n").isNull(), "negative": F.col("n") < 0}, "id")
    assert rows(good) == [("a", 1)] and rows(bad) == [("b", "no number"), ("c", "negative")]


def test_publish_replaces_the_old_content(spark, tmp_path):
    target = str(tmp_path / "out")
    publish(spark.range(5), target)
    before = read_published(spark, target)
    publish(read_published(spark, target).where("id < 2"), target, text=True)  # made from what it replaces
    assert rows(read_published(spark, target)) == [("0",), ("1",)]
    assert before.count() == 5  # a reader who has begun can finish
    publish(spark.range(7), target)
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2
    assert read_published(spark, target).count() == 7


def test_a_failed_publish_leaves_the_old_content(spark, tmp_path):
    target = str(tmp_path / "out")
    publish(spark.range(5), target)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, target)
    assert read_published(spark, target).count() == 5
    publish(spark.range(3), target)
    publish(spark.range(4), target)
    assert read_published(spark, target).count() == 4
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2  # what the failed run left is pruned too


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path))


def test_csv_and_report_sheets(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "id int, tags array<string>")
    write_csv(df, str(tmp_path / "csv"))
    assert rows(read_mapping_csv(spark, str(tmp_path / "csv"))) == [("1", '["a","b"]')] or spark.read.csv(
        str(tmp_path / "csv"), header=True, escape="\\").first()["id"] == "1"
    write_report({"summary": df, "details": df}, str(tmp_path / "report"))
    assert {p.name for p in (tmp_path / "report").iterdir()} == {"summary", "details"}


def test_published_view_coerces(spark):
    df = spark.createDataFrame([("PO1", "2025-01-02", "3.5"), (" ", "x", "y"), ("PO2", "x", "y")], "doc string, day string, n string")
    found = publish_view(df, {"doc": "Document", "day": "Day", "n": "N"}, ["day"], ["n"], key="doc")
    assert [(r["Document"], str(r["Day"]), r["N"]) for r in found.collect()] == [("PO1", "2025-01-02 00:00:00", 3.5), ("PO2", "None", None)]


def test_staging_uses_the_folder_the_cluster_names(spark):
    folder = tempfile.mkdtemp(prefix="staging-tests-")
    assert staged(spark.range(3), folder).count() == 3
    assert any(name.startswith("staged-") for name in os.listdir(folder))
    assert drop_staged(spark, folder) and not os.listdir(folder)


def test_small_table_is_seen_as_small(spark):
    df = small_table(spark, [("it's", 1, None), ("b\\", 2, True)], "a string, n int, f boolean")
    assert {tuple(r) for r in df.collect()} == {("b\\", 2, True), ("it's", 1, None)}


@pytest.mark.parametrize("name", list(FILES))
def test_files_written_and_read_back(spark, sf, name):
    state, detail = compare(spark, connect(sf), sf, FILES[name], FILE_ORACLE[name])
    assert state == "ok", detail


def test_json_documents_are_stored_small_in_files_of_bounded_rows(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 1).select("id", F.lit("Actual completion after target").alias("reason"), F.lit(None).cast("string").alias("none"))
    write_json(rows, str(tmp_path / "plain"))
    write_json(rows, str(tmp_path / "small"), compression="gzip", file_rows=300)
    size = lambda name: sum(part.stat().st_size for part in (tmp_path / name).glob("part-*"))
    assert len(list((tmp_path / "small").glob("part-*.gz"))) == 4 and 4 * size("small") < size("plain")
    read = spark.read.schema(rows.schema).json(str(tmp_path / "small"))
    assert read.exceptAll(rows).isEmpty() and read.count() == 1000
