"""Queries for the way from raw tables and tracker tabs to the reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.plans.intake import TRACKERS, Contract, read_text, report_inputs, tracker_rows
from ordertide.plans.intake import pulls
from ordertide.plans.status import status_report
from ordertide.plans.status.report import LINE_READ, enrich
from ordertide.session import staged

from .raw_tables import maps, raw_sources, raw_tabs, stage_tracker, tracker_tables
from .status_tables import AS_OF
from .tables import staging_dir, table


def _raw(make, *columns: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = make(raw_sources(spark, sf_dir))
        return rows.select(*columns) if columns else rows
    return query


def shipment_star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.shipment_lines_star(raw_sources(spark, sf_dir), staging=staging_dir(spark)).select(
        "shipment_number", "po_line_key", "quantity_expected", "gross_volume_cbm", "telex_release_date", "gate_in",
        "actual_inbound_date", "booking_confirmation_date", "asin", "pi_value", "ci_value", "bl_value", "bl_days", "amount", "invoice_numbers",
        "invoice_statuses", "invoice_amount", "invoice_quantity", "batch_telex_date")


def _tracker(*names: str):
    """The rows of some tabs as (tracker, key, column, value)."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tabs, out = raw_tabs(spark, sf_dir), None
        for name in names:
            spec = TRACKERS[name]
            pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in spec.outputs]))
            rows = tracker_rows(tabs[name], spec, AS_OF).select(F.lit(name).alias("tracker"), F.col(spec.key_as).alias("key"), pairs.alias("pair"))
            rows = rows.select("tracker", "key", "pair.field", "pair.value")
            out = rows if out is None else out.unionByName(rows)
        return out
    return query


def _stage_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.stage_dates(stage_tracker(spark, sf_dir), raw_sources(spark, sf_dir)["purchase_order_log"])


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = raw_sources(spark, sf_dir)
    # Six pulls read the log; stored, it is derived once and each reads its own columns.
    raw["purchase_order_log"] = staged(raw["purchase_order_log"], staging_dir(spark))
    return report_inputs(raw, tracker_tables(spark, sf_dir), maps(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is looked up for each open line, every table made from raw ones."""
    tables = inputs(spark, sf_dir)
    return enrich(tables["lines"].select(*LINE_READ), tables, staging_dir(spark)).select(
        "line_key", "shipment_number", "shipment_status", "batch_booking", "spd", "batch_sign_off", "vp_pi_status", "ns_pi_status", "md_blocker",
        "compliance_status", "supplier_vp_check", "transparency_pending", "packaging_l2", "pi_payment_status", "line_payment_approval",
        "l2_prd", "l2_compliance", "l2_g2", "l2_g4", "l2_spd", "l2_pickup", "l2_pi", "l2_qc", "l2_cprd", "ffw_blocker", "fob_date")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report from raw tables and tabs alone."""
    found = status_report(inputs(spark, sf_dir), AS_OF, "owner_9", "owner_8", staging=staging_dir(spark))
    return found.select("line_key", "batch_payment_type", "inb_payment_type", "batch_qc_pending", "batch_pickup_status", "shipping_status",
                        "supplier_telex", "current_status", "sub_code", "final_team")


ORDERS = Contract("o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_note string", ("o_orderkey",))


def source_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV with broken lines among them, read by contract: every line is in one of the two parts."""
    o = F.col("o_orderkey")
    price = F.when(o % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    day, note = F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(o % 5 == 0, F.lit('"a ""b"", c"')).otherwise(F.lit(""))
    key = F.when(o % 83 == 0, "").otherwise(o.cast("string"))
    whole = F.concat_ws(",", key, "o_orderstatus", price, day, note)
    line = F.when(o % 89 == 0, F.concat_ws(",", key, "o_orderstatus")).when(o % 79 == 0, F.concat(whole, F.lit(",too many"))).otherwise(whole)
    path = f"{staging_dir(spark).rstrip('/')}/contract-{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    good, broken = read_text(spark, path, ORDERS, header="false")
    shown = F.concat_ws("|", "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate", "o_note")
    # Of a row that only lacks its key the values are listed again; its line is not compared, as columns may be NULL.
    return good.select(F.lit("good").alias("part"), shown.alias("content")).unionByName(
        broken.select(F.col("reason").alias("part"), F.when(F.col("reason") == "broken line", F.col("line")).alias("content")))


QUERIES = {
    "source_contract": source_contract,
    "pull_po_lines": _raw(
        lambda raw: pulls.po_lines(raw["purchase_order_log"]), "document_number", "line_id", "id", "item", "final_status", "memo", "quantity",
        "quantity_received", "date_created", "first_prd", "accepted_prd", "batch_id", "snapshot_datetime"),
    "pull_packing_lists": _raw(lambda raw: pulls.packing_lists(raw["packing_list_log"])),
    "pull_batches": _raw(lambda raw: pulls.batches(raw["batch_lines"], raw["purchase_order_log"])),
    "pull_shipments": _raw(
        lambda raw: pulls.shipments(raw["shipment_headers"], raw["shipment_lines"], raw["purchase_order_log"]), "shipment_number", "po", "line_id",
        "shipped_line_id", "item", "status", "substatus", "quantity_expected", "quantity_remaining", "actual_arrival_date", "line_snapshot_date"),
    "pull_shipment_star": shipment_star_rows,
    "pull_telex": _raw(pulls.telex),
    "pull_pi_invoices": _raw(lambda raw: pulls.pi_invoices(raw["invoice_uploads"])),
    "pull_pi_status": _raw(lambda raw: pulls.pi_status(raw["payment_cohort"], raw["purchase_order_log"])),
    "pull_supplier_confirmation": _raw(lambda raw: pulls.supplier_confirmation(raw["supplier_order_log"])),
    "pull_master_data": _raw(lambda raw: pulls.master_data(raw["product_stages"], raw["purchase_order_log"])),
    "pull_compliance": _raw(lambda raw: pulls.compliance(raw["product_vendors"])),
    "pull_stage_dates": _stage_dates,
    "tracker_telex": _tracker("telex_ffw", "telex_supplier"),
    "tracker_fob": _tracker("fob"),
    "tracker_packaging": _tracker("packaging"),
    "tracker_transparency": _tracker("transparency_requests", "transparency_master"),
    "tracker_payrun": _tracker("payrun"),
    "tracker_compliance": _tracker("l2_compliance"),
    "tracker_line_remarks": _tracker("l2_prd", "l2_cprd", "l2_qc", "l2_g2"),
    "tracker_batch_remarks": _tracker("spd_blockers", "g4", "ffw_status"),
    "tracker_prepayment": _tracker("prepayment"),
    "tracker_forwarder_blockers": _tracker("ffw_blockers"),
    "report_inputs": enriched,
    "report_from_raw": report,
}
