"""Status report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators import open_lines
from ordertide.plans.status import (
    add_invoice_submitted, add_line_paid, add_line_payment_type, add_pending, add_prd_decision, attach_stage_days,
    full_view, status_report, sub_stage_columns,
)
from ordertide.plans.status.attributes import booking_status
from ordertide.plans.status.ladder import STAGES, flag_column
from ordertide.plans.status.report import STAGE, at_current_stage, enrich, published, status_lines

from ordertide.plans.timeline import Stage, stage_delay, stages_long, timeline
from ordertide.session import staged

from .status_tables import AS_OF, log_lines, po_lines, status_tables
from .tables import staging_dir, table


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line_key", F.concat("document_number", "item", "line_id"))


def _open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(open_lines(po_lines(spark, sf_dir)))


def _settled(*columns: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = status_tables(spark, sf_dir)
        df = status_lines(tables, AS_OF, staging_dir(spark), shown=False)
        return df.select("line_key", *columns)
    return query


def _report(*columns: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _whole(spark, sf_dir).select("line_key", *columns)
    return query


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_report(status_tables(spark, sf_dir), AS_OF, "owner_9", "owner_8", staging=staging_dir(spark))


def open_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _open(spark, sf_dir).select("line_key", "final_status", "memo", "quantity", "quantity_received")


def payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = add_line_paid(add_invoice_submitted(add_line_payment_type(_open(spark, sf_dir))))
    return df.select("line_key", "pi", "ci", "bl", "bl_days", "line_payment_type",
                     "line_invoice_submission", "line_payment_status")


def lookup_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single lookups, one of them from a table in which the last row of a key counts."""
    tables = status_tables(spark, sf_dir)
    return enrich(tables["lines"], tables).select(
        "line_key", "expected_arrival_date", "fob_status", "spd_delay_reason", "transparency_pending")


def booking_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    batches = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(o % 5 == 0, "Cancelled").when(o % 5 == 1, "").when(o % 5 > 2, "Confirmed").alias("vp_booking_status"),
        F.when(o % 3 != 0, "FFW").alias("freight_forwarder"),
    )
    return batches.select("o_orderkey", booking_status().alias("booking"))


def sub_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sub_stage_columns(_whole(spark, sf_dir))
    return df.select("line_key", *[f"sub_{code.lower()}" for code in STAGES])


def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 204 columns."""
    return full_view(_whole(spark, sf_dir))


def late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's lines with the days that they are late in their current stage, by the timeline."""
    lines = staged(_whole(spark, sf_dir).select("line_key", "document_number", "line_id", "status_code", "days"), staging_dir(spark))
    planned = F.col("l_shipdate").cast("timestamp")
    dates = log_lines(spark, sf_dir).groupBy("document_number", "item", "line_id").agg(
        F.min(planned).alias("po_created_date"), F.max(planned).alias("shipped"), F.min("k").alias("k"))
    dates = dates.select(F.concat("document_number", "item", "line_id").alias("po_id"), "po_created_date",
                         F.when(F.col("k") % 3 != 0, F.col("shipped")).alias("shipped"))
    stages = [Stage(str(n), f"Stage {n}", "shipped", None, "po_created_date", n) for n in range(1, 32)]
    dates = at_current_stage(dates, lines)
    delays = stages_long(stage_delay(timeline(dates, stages, keep=["po_id", STAGE]), stages, AS_OF), stages, ["po_id", STAGE])
    delays = delays.where(F.col("stage_id") == F.col(STAGE))
    return attach_stage_days(lines, delays).select("line_key", "status_code", "days")


QUERIES = {
    "full_report": full_report,
    "late_days": late_days,
    "open_lines": open_line_rows,
    "pending_units": lambda spark, sf: add_pending(_open(spark, sf)).select("line_key", "pending_units", "pending_value"),
    "prd_decision": lambda spark, sf: add_prd_decision(_open(spark, sf)).select("line_key", "prd_delay_decision"),
    "payment_types": payment_types,
    "group_payments": _settled(
        "batch_payment_type", "batch_invoice_submission", "batch_payment_status", "batch_payment_approval",
        "inb_payment_type", "inb_invoice_submission", "inb_payment_status", "inb_payment_approval"),
    "lookup_instances": lookup_instances,
    "qc_status": _settled("qc_stage", "qc_pending", "batch_qc_pending", "max_qc_date", "max_qc_state"),
    "pickup_status": _settled("batch_pickup_status", "vp_booking_status", "shipping_status"),
    "estimated_delivery": _settled("estimated_delivery_date"),
    "telex_cascade": _settled("shipment_number", "supplier_telex", "sm_telex", "ffw_telex"),
    "team_priority": _settled("team", "focus"),
    "batch_compliance": _settled("compliance_status", "batch_compliance"),
    "master_blocker": _settled("md_blocker", "flag_d"),
    "booking_rule": booking_rule,
    "stage_flags": _report(*[flag_column(code) for code in STAGES]),
    "current_stage": _report("current_status", "status_code"),
    "sub_stage": _report("current_status", "sub_status", "sub_code"),
    "sub_stage_columns": sub_columns,
    "blocker_owner": _report("pickup_blocker", "l2_telex", "l2_final_status", "accountable", "responsible",
                             "final_responsibility", "final_poc", "final_team"),
    "status_report": lambda spark, sf: published(_whole(spark, sf)),
}
