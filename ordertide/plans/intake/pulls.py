"""From raw warehouse tables to the tables that the status report and the timeline read.

Every pull takes raw tables as ``contracts`` describes them and returns one row per key. The latest snapshot of a line is
found once per use, by a window that Spark prunes in each map task; a rule that keeps tied rows and then tests them
ranks the rows that pass before the others, which gives the same answer with one shuffle and one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import to_ts
from ...functions.text import after, after_n, before, last_n, parse_terms, prefix
from ...functions.values import pan_eu_group, present
from ...operators.aggregates import cond_min, list_and_sum, max_by_key
from ...operators.latest import distinct_values, earliest, first_by, keep_by_priority, latest
from ...operators.lookups import PAYMENT_PRIORITY, header_lines, inner_lookup, map_values, restrict_to, shipment_star
from ...operators.projections import CLOSED_STATUSES, EXCLUDED_MEMO, open_lines
from ...operators.row_tables import stored_star
from ...session import staged
from ..status.attributes import booking_status

LINE = ["document_number", "line_id"]
DAY, MINUTE, SECOND = "dd.MM.yyyy", "dd.MM.yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"
UPLOAD_DAY = "yyyy.MM.dd"

# Statuses of uploaded documents and the label each stands for.
SIGN_OFF = {
    "accepted-ffw": "Signed-Off", "accepted-sm": "14c. FFW Sign-Off Missing", "ocr1-accepted": "14b. SM Sign-Off Missing",
    "uploaded": "14b. SM Sign-Off Missing", "ocr2-rejected": "14b. SM Sign-Off Missing", "ocr2-accepted": "14b. SM Sign-Off Missing",
    "rejected-ffw": "14a. Documents Missing",
}
BATCH_ID_LENGTH = 12
PI_UPLOAD_PENDING = "03. PI Upload Pending"
INVOICE_LABELS = {
    "ocr1-accepted": "04a. SM Review Pending", "ocr2-accepted": "04a. SM Review Pending", "uploaded": "04a. SM Review Pending",
    "accepted": "04b. Accounting Approval Pending", "pending-ns": "04b. Accounting Approval Pending",
    "open-ns": "05b. Pending Approval", "rejected-ns": "05b. Pending Approval", "paid": "05a. Approved",
}
BLOCKER_LABELS = {"None": "No Blocker", "Reroute to non-Blocked Geo or Cancel PO": "Reroute or Cancel"}
ARRIVED_STATES = ("partiallyReceived", "received")


def _outstanding() -> Column:
    return (F.col("quantity") - F.coalesce("quantity_received", F.lit(0))) > 0


def _not_closed() -> Column:
    return F.coalesce(~F.col("final_status").isin(*CLOSED_STATUSES), F.lit(False))


def _tracked() -> Column:
    memo = F.col("memo").isNull() | (F.col("memo") != EXCLUDED_MEMO)
    return _not_closed() & F.coalesce((F.col("quantity") - F.col("quantity_received")) > 0, F.lit(False)) & memo


def latest_passing(log: DataFrame, keys: Sequence[str], moment: str, test: Column, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Of the rows that share the latest moment of a key, one that passes ``test``; keys where none passes are left out."""
    order = [F.col(moment).desc_nulls_last(), test.desc(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    return first_by(log, list(keys), order).where(test)


def po_lines(log: DataFrame) -> DataFrame:
    """The latest state of each line that is open; rows that tie are told apart by ``id``."""
    lines = open_lines(latest_passing(log, LINE, "snapshot_datetime", _tracked(), ["id"]))
    return lines.withColumns({
        "date_created": to_ts("date_created", MINUTE), "first_prd": to_ts("first_prd", DAY), "accepted_prd": to_ts("accepted_prd", DAY)})


def packing_lists(log: DataFrame) -> DataFrame:
    """The sign-off state of each batch, by its last upload."""
    batch = before("shipment_batch_pl", "#")
    known = log.where(F.col("pl_status").isin(*SIGN_OFF) & (F.length(batch) == BATCH_ID_LENGTH))
    rows = latest(known, [batch], [to_ts("created_date", UPLOAD_DAY), to_ts("approximate_ts", SECOND), "pl_status"])
    return rows.select(batch.alias("batch_id"), map_values("pl_status", SIGN_OFF).alias("batch_sign_off"))


def batches(batch_lines: DataFrame, log: DataFrame) -> DataFrame:
    """The greatest value of each column of a batch, for batches that still have an open line."""
    current = latest_passing(log.where("batch_id IS NOT NULL"), ["batch_id", "line_id"], "snapshot_datetime", _not_closed())
    kept = restrict_to(batch_lines, current, "batch_id")
    tops = max_by_key(kept, "batch_id", [c for c in batch_lines.columns if c != "batch_id"])
    return tops.withColumn("batch_booking", booking_status())


def shipments(headers: DataFrame, lines: DataFrame, log: DataFrame) -> DataFrame:
    """Shipment lines with their header, where the ordered line still has something outstanding."""
    known = headers.where(present("shipment_number").isNotNull()).withColumnRenamed("snapshot_date", "header_snapshot_date")
    inner = lines.withColumnsRenamed({"snapshot_date": "line_snapshot_date"}).withColumn("shipped_line_id", after("join_column", "_"))
    current = latest_passing(log, LINE, "snapshot_datetime", _outstanding()).select("po_line_key", "line_id")
    return inner_lookup(header_lines(known, inner, "shipment_number"), current, "po_line_key", F.lit(True))


def shipment_sides(raw: Mapping[str, DataFrame], staging: str | None = None) -> dict[str, tuple[list[str], DataFrame]]:
    """What is known of a shipment or its lines elsewhere, each reduced to one row per key.

    With ``staging`` the terms, which come from the whole log, are written there. ``notes`` is a log of changed fields: the first time a field went from one value to another becomes a column.
    """
    changed = lambda field: F.col("field") == field
    arrived = changed("Status") & F.col("new_value").isin(*ARRIVED_STATES) & (F.col("old_value") == "inTransit")
    booked = changed("External Document Number") & F.col("new_value").isNotNull() & F.col("old_value").isNull()
    notes = cond_min(raw["shipment_notes"], "record", {"actual_inbound_date": (arrived, "date"), "booking_confirmation_date": (booked, "date")})
    order = ["po_line_key", "supplier_payment_terms", "asin", "batch_id", "item_rate_eur"]
    terms = latest(raw["purchase_order_log"], ["po_line_key"], ["snapshot_datetime", "id"]).select(*order)
    terms = terms.select("po_line_key", "asin", "batch_id", F.col("item_rate_eur").alias("amount"), *[
        column.alias(name) for name, column in parse_terms("supplier_payment_terms").items()])
    terms = staged(terms, staging) if staging else terms
    invoices = list_and_sum(raw["invoice_lines"], "po_line_key", {"invoice_numbers": "document_number", "invoice_statuses": "status"},
                            {"invoice_amount": "amount_eur", "invoice_quantity": "quantity"})
    uploads = raw["packing_list_log"].where(F.col("telex_status") == "uploaded").select(
        before("shipment_batch_pl", "#").alias("batch_id"), to_ts("created_date", UPLOAD_DAY).alias("day"))
    telex = max_by_key(uploads, "batch_id", {"batch_telex_date": "day"})
    return {
        "notes": (["shipment_number"], notes.withColumnRenamed("record", "shipment_number")),
        "terms": (["po_line_key"], terms), "invoices": (["po_line_key"], invoices), "telex": (["batch_id"], telex),
    }


def shipment_lines_star(
    raw: Mapping[str, DataFrame], sides: Sequence[str] = ("notes", "terms", "invoices", "telex"), staging: str | None = None,
) -> DataFrame:
    """Every shipment line with what is known of it; ``sides`` limits what is joined, so the rest is not read. ``staging``
    names a shared folder for intermediate rows."""
    headers = raw["shipment_headers"].drop("snapshot_date", "date_created").withColumns({
        name: to_ts(name, DAY) for name in ("telex_release_date", "gate_in", "gate_out", "customs_clearance_date")})
    volume = F.when(F.coalesce("gross_volume_cbm", F.lit(0)) == 0, F.col("net_volume_cbm")).otherwise(F.col("gross_volume_cbm"))
    headers = headers.withColumn("gross_volume_cbm", volume)
    lines = raw["shipment_lines"].select("shipment_number", "po", "item", "vendor", "quantity_expected", "quantity_received", "po_line_key")
    known = shipment_sides(raw, staging)
    star, chosen = header_lines(headers, lines, "shipment_number"), {name: known[name] for name in sides}
    return stored_star(star, chosen, staging) if staging else shipment_star(star, chosen, ["shipment_number", "po_line_key"])


def telex(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Latest telex release by supplier (of the batch) and by forwarder (of the shipment)."""
    star = shipment_lines_star(raw, ("terms", "telex"))
    return max_by_key(star, "shipment_number", {"telex_supplier_date": "batch_telex_date", "telex_ffw_date": "telex_release_date"})


def pi_invoices(uploads: DataFrame) -> DataFrame:
    """The last upload of each document and invoice type, with the label of its status."""
    typed = uploads.withColumn("moment", to_ts("approximate_ts", SECOND)).withColumn("kind", before("invoice_type_id", "#"))
    last = latest(typed, ["vendor_po", "kind"], ["moment", "invoice_type_id"])
    return last.select(
        F.nullif(after_n("vendor_po", "#", 8), F.lit("")).alias("document_number"), "vendor_po", "kind", "moment", "invoice_status",
        map_values("invoice_status", INVOICE_LABELS, PI_UPLOAD_PENDING).alias("vp_pi_status"))


def pi_status(cohort: DataFrame, log: DataFrame) -> DataFrame:
    """Payment documents of open orders at their latest snapshot: (document_number, ns_pi_status), the best status of each order."""
    current = latest(cohort, ["document_number"], ["snapshot_date"], ties=True)
    current = current.where("source_po IS NOT NULL AND document_number NOT LIKE '%cancelled%'")
    current = current.withColumn("po", present(last_n("source_po", 8))).where("po IS NOT NULL")
    orders = latest(log, ["document_number"], ["snapshot_datetime"], ties=True).where(_not_closed()).select(F.col("document_number").alias("po"))
    rows = distinct_values(restrict_to(current, orders, "po"), ["po", "status"])
    best = keep_by_priority(rows, ["po"], "status", PAYMENT_PRIORITY, "best", ["status"])
    return best.select(F.col("po").alias("document_number"), F.col("status").alias("ns_pi_status"))


def supplier_confirmation(log: DataFrame) -> DataFrame:
    """The first portal entry of each order."""
    known = log.where(present("po_number").isNotNull()).withColumn("moment", to_ts("approximate_ts", SECOND))
    rows = earliest(known, ["po_number"], ["moment", "po_status"])
    return rows.select(F.col("po_number").alias("document_number"), "moment", "po_status")


def master_data(stages: DataFrame, log: DataFrame) -> DataFrame:
    """The latest block of each article in its market, if any snapshot had something outstanding of it."""
    wanted = log.where(_outstanding()).select("item", "marketplace")
    blocked = stages.where(present("block_reason_code").isNotNull())
    rows = latest(restrict_to(blocked, wanted, ["item", "marketplace"]), ["item", "marketplace"], ["snapshot_date", "block_reason_code"])
    return rows.select("item", "marketplace", "operating_status", "block_reason_code",
                       map_values("open_stock_impact", BLOCKER_LABELS, F.col("open_stock_impact")).alias("md_blocker"))


def compliance(vendors: DataFrame) -> DataFrame:
    """Compliance of each article, market and vendor; the first entry by ``id`` counts."""
    rows = earliest(vendors.withColumn("vendor_id", prefix("vendor", r"^(\S+)").try_cast("long")), ["item", "marketplace", "vendor_id"], ["id"])
    return rows.select("item", "marketplace", "vendor_id", "compliance_status", F.col("compliance_test_results").alias("deal_stage"),
                       F.concat(F.trim("item"), pan_eu_group("marketplace")).alias("article_market"))


def stage_dates(tracker: DataFrame, log: DataFrame) -> DataFrame:
    """Stage dates of the lines that are open, with the visible line id: the timeline's input."""
    wanted = latest_passing(log, LINE, "snapshot_datetime", _tracked()).select(F.col("document_number").alias("po_number"), "line_id")
    kept = restrict_to(tracker, wanted, ["po_number", "line_id"])
    return kept.select(F.concat("po_number", "item", "line_id").alias("po_id"), *[c for c in tracker.columns if c not in ("po_number", "item", "line_id")])
