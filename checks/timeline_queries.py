"""Stage timeline queries: every line of ``lineitem`` is a purchase-order line."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.dates import parse_any_date
from ordertide.plans.timeline import (
    TIMELINE_DATES, documents, explain_stages, flat_tables, global_delay, insights, method_counts, po_delay_summary,
    read_documents, stage_delay, stage_dim, stage_matrix, stage_wide, stages_from_dict, stages_long,
    standard_stages, team_delay, timeline, timeline_or_failures, with_stage_dim, worst_team,
)
from ordertide.sources import coerce_dates, null_profile, write_json

from .tables import AS_OF, stage_dates, staging_dir

#: Six stages of one kind each: first with a fallback date, plain, of some lines only, after one or two others, after
#: two with a fallback that reads a stage, and without predecessors or an actual date.
SMALL_CONFIG = {"stages": {
    "1": {"name": "Ready date known", "actual_timestamp": "receive_first_prd_date", "preceding_stage": None,
          "process_flow": {"critical_path": True, "process_type": "planning", "team_owner": "Desk"},
          "fallback_calculation": {"expression": "po_created_date"}, "lead_time": 4},
    "2": {"name": "Goods released", "actual_timestamp": "sm_signoff_ts", "preceding_stage": "['1']",
          "process_flow": {"critical_path": True, "process_type": "release", "team_owner": "Desk"},
          "fallback_calculation": {"expression": ""}, "lead_time": 1},
    "3": {"name": "Inspection", "actual_timestamp": "qc_schedule_date",
          "preceding_stage": "cond(ci_applicable == 0, ['1'], [])",
          "process_flow": {"critical_path": False, "process_type": "check", "team_owner": "Lab",
                           "parallel_processes": ["2"]},
          "fallback_calculation": {"expression": "max(batch_created_ts, add_days(po_sm_date_value, 6))"},
          "lead_time": 2},
    "4": {"name": "Space booked", "actual_timestamp": "ffw_booking_ts",
          "preceding_stage": "cond(pi_applicable != 1, ['3', '2'], ['1'])",
          "process_flow": {"critical_path": True, "process_type": "booking", "team_owner": "Freight",
                           "parallel_processes": ["2", "3"]},
          "fallback_calculation": {"expression": "None"}, "lead_time": 7},
    "5": {"name": "Departure", "actual_timestamp": "actual_shipping_date", "preceding_stage": "['3', '4']",
          "process_flow": {"critical_path": True, "process_type": "transport", "team_owner": "Freight"},
          "fallback_calculation": {"expression": "stage_3 + 9"}, "lead_time": 0},
    "6": {"name": "Stock in", "actual_timestamp": "", "preceding_stage": "",
          "process_flow": {"critical_path": True, "process_type": "storing", "team_owner": "Dock"},
          "fallback_calculation": {"expression": "max(item_receipt_date, stage_5 + plt - 8)"}, "lead_time": 3},
}}
ID = ["po_id"]
#: How documents are stored: compressed, in files that one task reads in a short time.
STORED = {"compression": "gzip", "file_rows": 50_000}


def small():
    return stages_from_dict(SMALL_CONFIG)


def _timeline(spark, sf_dir, stages, variant="modular", keep=("po_id",)):
    return timeline(stage_dates(spark, sf_dir), stages, variant, list(keep))


def _delays(spark, sf_dir, stages, mode="report", keep=("po_id",)):
    return stage_delay(_timeline(spark, sf_dir, stages, keep=keep), stages, AS_OF, mode)


def _flat(df: DataFrame, stages, fields) -> DataFrame:
    return df.select("po_id", *[
        F.col(f"stage_{stage.stage_id}.{field}").alias(f"{shown}_{stage.stage_id}")
        for stage in stages for field, shown in fields.items()
    ])


def _variant(variant):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = {"date": "date", "method": "method", "target_date": "target", "precedence_date": "reached"}
        if variant == "notebook":
            fields = {"date": "date", "method": "method"}
        return _flat(_timeline(spark, sf_dir, small(), variant), small(), fields)
    return query


def timeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = standard_stages()
    return _flat(_timeline(spark, sf_dir, stages), stages, {"date": "date", "method": "method"})


def stage_delay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stages_long(_delays(spark, sf_dir, small()), small(), ID)
    return rows.select("po_id", "stage_id", "target_timestamp", "actual_date", "delay_days",
                       "delay_status", "delay_reason", "team_responsible")


def stage_delay_integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    delays = _delays(spark, sf_dir, small(), "integrated")
    return delays.select("po_id", *[
        F.col(f"delay_{stage.stage_id}.{field}").alias(f"{field}_{stage.stage_id}")
        for stage in small() for field in ("days", "status")
    ])


def _full(report):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stages = standard_stages()
        return report(_delays(spark, sf_dir, stages), stages, ID)
    return query


def method_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return method_counts(_timeline(spark, sf_dir, standard_stages()), standard_stages(), ID)


def insight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = insights(_delays(spark, sf_dir, standard_stages()), standard_stages(), ID)
    return found.select("po_id", F.array_join("insights", " | ").alias("insights"))


def global_delay_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_delay(_delays(spark, sf_dir, standard_stages()), standard_stages(), "po_id")


def _matrix(measure):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stages = standard_stages()
        source = _delays(spark, sf_dir, stages) if measure == "delay" else _timeline(spark, sf_dir, stages)
        return stage_matrix(source, stages, measure, ID)
    return query


def stage_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["po_id", "po_created_date", "ci_applicable"]
    return stage_wide(_delays(spark, sf_dir, small(), "integrated", kept), small(), kept)


def dependency_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["po_id", "pi_applicable", "ci_applicable"]
    rows = explain_stages(_timeline(spark, sf_dir, small(), keep=kept), small(), ID)
    listed = F.transform("dependencies", lambda d: F.concat_ws(
        "@", d["stage_id"], d["stage_name"], F.date_format(d["date"], "yyyy-MM-dd HH:mm"), d["method"]
    ))
    return rows.select("po_id", "stage_id", "source", "decision", "reason",
                       F.array_join(listed, ";").alias("dependencies"))


def stage_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = small()
    rows = stages_long(_timeline(spark, sf_dir, stages), stages, ID, delays=False)
    named = with_stage_dim(rows.select("po_id", "stage_id", "stage_name", "date"), stage_dim(spark, stages))
    return named.select(
        "po_id", "stage_id", "stage_name", "date", "team_owner", "process_type", "critical_path", "lead_time",
        F.array_join("parallel_processes", ",").alias("parallel_processes"),
        F.size("handoff_points").alias("handoff_points"),
    )


def null_profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates arrive as text, some unreadable; they are coerced and their gaps counted."""
    names = list(TIMELINE_DATES)
    source = stage_dates(spark, sf_dir)
    text = source.select(*[
        F.when(F.col(name).isNull(), F.lit("NA")).otherwise(F.date_format(name, "yyyy-MM-dd HH:mm:ss")).alias(name)
        for name in names
    ])
    return null_profile(coerce_dates(text, names), names)


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in four styles, blank and not at all."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.col("o_orderdate").cast("timestamp")
    style = F.col("o_orderkey") % 7
    text = (
        F.when(style == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(style == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(style == 3, F.concat(F.lit("25/"), F.date_format(day, "MM/yyyy")))
        .when(style == 4, F.lit("NA")).when(style == 5, F.lit(" ")).otherwise(F.lit("soon"))
    )
    return orders.select("o_orderkey", parse_any_date(text).alias("parsed"))


#: Stages whose predecessors depend on comparisons that some rows cannot answer.
FAILING_CONFIG = {"stages": {
    "1": {"name": "Ready", "actual_timestamp": "receive_first_prd_date", "preceding_stage": None,
          "fallback_calculation": {"expression": "po_created_date"}, "lead_time": 1},
    "2": {"name": "Checked", "actual_timestamp": "qc_schedule_date", "preceding_stage": "cond(plt > 30, ['1'], [])",
          "fallback_calculation": {"expression": "max(batch_created_ts, receive_first_prd_date)"}, "lead_time": 2},
    "3": {"name": "Sent", "actual_timestamp": "spd_ts", "preceding_stage": "cond(stage_2 >= po_created_date, ['2'], ['1'])",
          "fallback_calculation": {"expression": ""}, "lead_time": 0},
}}


def timeline_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that arrive as text, some of them no dates: errors by stage, and the last date of the rows that go on."""
    source = stage_dates(spark, sf_dir)
    text = F.date_format("receive_first_prd_date", "yyyy-MM-dd HH:mm:ss")
    source = source.withColumn("receive_first_prd_date", F.when(F.col("plt") == 41, "soon").when(F.col("plt") == 42, " ").otherwise(text))
    good, failures = timeline_or_failures(
        source, stages_from_dict(FAILING_CONFIG), ID, keep=ID, text_dates=["receive_first_prd_date"])
    passed = good.select("po_id", F.lit("3").alias("stage_id"), F.lit("date").alias("part"),
                         F.date_format("stage_3.date", "yyyy-MM-dd HH:mm").alias("error"), F.lit(False).alias("fatal"))
    return failures.unionByName(passed)


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as JSON, read back and flattened again: stages with delays and dependencies."""
    kept = ["po_id", "pi_applicable", "ci_applicable"]
    made = documents(_delays(spark, sf_dir, small(), keep=kept), small(), ID)
    path = f"{staging_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    write_json(made, path, **STORED)
    flat = flat_tables(read_documents(spark, path), ID)
    needs = flat["dependencies"].groupBy("po_id", "stage_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("position", "needs", "needs_date"))),
        lambda d: F.concat(d["needs"], F.lit("@"), F.date_format(d["needs_date"], "yyyy-MM-dd HH:mm"))), ";").alias("needs"))
    stages = flat["stages"].join(needs, ["po_id", "stage_id"], "left").join(
        flat["summary"].select("po_id", "calculated_stages", "delayed_stages", "total_delay_days"), "po_id")
    return stages.select("po_id", "stage_id", "stage_name", "date", "method", "lead_time_days", "team_owner", "delay_days", "delay_status",
                         F.coalesce("needs", F.lit("")).alias("needs"), "calculated_stages", "delayed_stages", "total_delay_days")


def document_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The teams and remarks of the documents, read back from JSON."""
    stages = standard_stages()
    made = documents(_delays(spark, sf_dir, stages, keep=["po_id", "pi_applicable", "ci_applicable"]), stages, ID)
    path = f"{staging_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    write_json(made.select("po_id", "delays_by_team", "insights"), path, **STORED)
    return flat_tables(read_documents(spark, path), ID)["teams"]


QUERIES = {
    "timeline_failures": timeline_failures,
    "timeline_documents": document_rows,
    "timeline_document_teams": document_teams,
    "timeline_small": _variant("modular"),
    "timeline_legacy": _variant("legacy"),
    "timeline_notebook": _variant("notebook"),
    "timeline_full": timeline_full,
    "stage_delay": stage_delay_rows,
    "stage_delay_integrated": stage_delay_integrated,
    "method_counts": method_count_rows,
    "po_delay_summary": _full(po_delay_summary),
    "team_delay": _full(team_delay),
    "worst_team": _full(worst_team),
    "insights": insight_rows,
    "global_delay": global_delay_row,
    "stage_matrix_actual": _matrix("actual"),
    "stage_matrix_computed": _matrix("computed"),
    "stage_matrix_delay": _matrix("delay"),
    "stage_wide": stage_wide_rows,
    "stage_dependencies": dependency_rows,
    "stage_metadata": stage_metadata,
    "null_profile": null_profile_rows,
    "parse_dates": parse_dates,
}
