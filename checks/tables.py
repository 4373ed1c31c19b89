"""Inputs derived by Spark from the test tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.dates import plus_days, plus_hours
from ordertide.plans.timeline.standard import TIMELINE_DATES
from ordertide.sources import read_table

_OWN: list[str] = []


def staging_dir(spark: SparkSession) -> str:
    """The session's shared folder; for local checks that name none, one temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="checks-"))
    return _OWN[0]


AS_OF = "2001-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def stage_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the change log as a purchase-order line with its stage dates.

    Dates are spread by a number made of the line's keys: a line has reached ``h % 33`` of the
    steps, one step in nine is missing, and steps may be out of order.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem").select(columns).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    lines = lines.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("po_id"),
        (F.col("l_orderkey") * 7 + F.col("l_partkey") * 13 + F.col("l_suppkey") * 3
         + F.col("l_linenumber") * 5).alias("h"),
        F.coalesce("o_orderdate", plus_days("l_shipdate", -90)).alias("po_created_date"),
    )
    # One row group of the test tables is one task, which would do all the work that follows.
    lines = lines.repartition("po_id")
    h = F.col("h")
    dates = []
    for k, name in enumerate(TIMELINE_DATES[1:], start=1):
        hours = (F.lit(k * 4 - 3) + h * k % 13) * 24 + (h + k) % 24
        seen = (F.lit(k) <= h % 33) & ((h + k * 11) % 9 != 0)
        dates.append(F.when(seen, plus_hours("po_created_date", hours)).alias(name))
    return lines.select(
        "po_id", "po_created_date", *dates,
        F.when(h % 4 == 0, F.lit(None).cast("int")).otherwise((h % 4 < 3).cast("int")).alias("pi_applicable"),
        (h % 3 == 0).cast("int").alias("ci_applicable"),
        F.when(h % 5 != 0, (h % 30 + 20).cast("int")).alias("plt"),
    )
