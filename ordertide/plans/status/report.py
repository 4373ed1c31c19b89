"""The status report: all enrichment, group statuses, ladder and ownership in one plan.

Reference tables that share a key are joined one after the other, so lines are moved once per key: line, document,
article, batch, shipment. ``staging`` names a shared folder to which the lines are written with row numbers, and what is
found for them beside them (``RowTables``). Per key only numbers and keys are moved then, and the lines once. The caller
drops the folder when the report is written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.text import first_word, joined
from ...functions.values import latam_group
from ...operators.latest import keep
from ...operators.lookups import checked_unique, lookup, lookup_many, union_override
from ...operators.projections import publish_view
from ...operators.rollups import roll_up
from ...operators.row_tables import RowTables
from . import attributes as attr
from .ladder import codes, current_stage, stage_flags, stage_rules, sub_stage
from .ownership import add_pickup_blocker, l2_final, l2_telex, poc, responsibility, team_of

ROW = "_row"
LINE, DOCUMENT, ARTICLE = ["document_number", "item", "line_id"], ["document_number"], ["document_number", "item"]
#: Hand-kept tables may name a line or an article by its visible id instead.
VISIBLE = {"line_key": LINE, "article_key": ARTICLE}

# What an unmatched line shows.
DEFAULTS = {
    "placement_batch": "Other", "ns_pi_status": "Not Submitted", "vp_pi_status": "03. PI Upload Pending",
    "pi_payment_status": "Not In Payment Sheet", "supplier_vp_check": "Not Available on VP",
    "transparency_check": "No", "transparency_pending": "Missing", "packaging_pending": "Yes",
    "batch_sign_off": "14a. Documents Missing", "compliance_status": "Missing", "md_blocker": "No Blocker",
    "ffw_blocker": "No", "cm": "", "sm": "", "fob_status": "", "spd_delay_reason": "",
    "l2_compliance": "Not in Compliance Sheet", "l2_pi": "Not in PI Sheet", "l2_prd": "Not in PRD Sheet",
    "l2_cprd": "Not in CPRD Sheet", "l2_g2": "Not in G2 Sheet", "l2_g4": "Not in G4 Sheet",
    "l2_qc": "Not in QC Sheet", "l2_spd": "Not in SPD Sheet", "l2_pickup": "Not in FFW Sheet",
}

# Published columns, inside name -> shown name, in published order.
PUBLISHED = {
    "id": "id", "date_created": "date_created", "document_number": "document_number",
    "associated_brands": "scm_associated_brands", "po_vendor": "po_vendor",
    "supplier_confirmation_status": "supplier_confirmation_status", "final_status": "final_status",
    "memo": "scm_po_scm_memo", "marketplace": "marketplace_header",
    "supplier_payment_terms": "supplier_payment_terms", "incoterms": "incoterms", "line_id": "line_id",
    "item": "item", "asin": "asin", "quantity": "quantity",
    "quantity_received": "quantity_fulfilled/received", "quantity_on_shipments": "quantity_on_shipments",
    "first_prd": "first_prd", "prd": "prd", "planned_prd": "planned_prd", "confirmed_crd": "confirmed_crd",
    "quality_control_date": "quality_control_date", "quality_control_status": "quality_control_status",
    "im_line_signoff": "im_line_signoff", "sm_line_signoff": "sm_line_signoff",
    "production_status": "production_status", "batch_id": "batch_id", "wh_type": "wh_type",
    "considered_anti_po": "considered_for_anti-po", "prd_reconfirmation": "prd_reconfirmation",
    "invoice_number": "invoice_number", "invoice_status": "invoice_status",
    "placement_batch": "Placement Batch", "focus": "OTIF Focus", "mp": "MP", "item_rate_eur": "item_rate_eur",
    "pending_units": "Pending Units", "pending_value": "Pending Value", "line_key": "po_razin_id",
    "line_payment_type": "Line Payment Type", "batch_payment_type": "Batch Payment Type",
    "inb_payment_type": "INB Payment Type", "line_invoice_submission": "Line Invoice Submission Status",
    "batch_invoice_submission": "Batch Invoice Submission Status",
    "inb_invoice_submission": "INB Invoice Submission Status", "line_payment_status": "Line Payment Status",
    "batch_payment_status": "Batch Payment Status", "inb_payment_status": "INB Payment Status",
    "batch_qc_pending": "Batch QC Pending", "vp_booking_status": "VP Booking Status", "fob_date": "FOB Date",
    "batch_pickup_status": "Batch Pickup Status", "shipping_status": "Shipping Status",
    "shipment_number": "INB#", "shipment_status": "Status", "substatus": "Substatus",
    "estimated_delivery_date": "Estimated OTIF Delivery Date", "supplier_telex": "Supplier Telex Status",
    "sm_telex": "SM Telex Status", "ffw_telex": "FFW Telex Status", "cm": "CM", "sm": "SM",
    "compliance_status": "Compliance Status", "current_status": "Current Status", "sub_status": "Sub Status",
    "days_bucket": "Days Bucket", "team": "Team", "reporting_status": "Reporting Status",
    "l2_final_status": "L2 Final Status", "final_poc": "Final POC", "final_team": "Final Team",
}
PUBLISHED_DATES = ("prd", "planned_prd", "confirmed_crd", "quality_control_date", "fob_date", "estimated_delivery_date")
PUBLISHED_NUMBERS = ("item_rate_eur", "pending_units", "pending_value")


#: Fixed rule: of a key loaded twice the first row counts, but for these tables the last.
LAST_LOADED = ("transparency_requests",)


def _one(tables: Mapping[str, DataFrame], name: str, keys: list[str]) -> DataFrame:
    """A reference table with one row per key: picked by ``load_seq``, or else checked to be unique."""
    df = tables[name]
    if "load_seq" not in df.columns:
        return checked_unique(df, keys)
    return keep(df, keys, "last" if name in LAST_LOADED else "first", "load_seq").drop("load_seq")


def _line_columns() -> dict:
    return {
        "line_key": joined(*LINE), "article_key": joined(*ARTICLE), "mp": latam_group("marketplace"),
        "vendor_id": first_word("po_vendor").try_cast("long"),
    }


def _line_lookups(tables: Mapping[str, DataFrame]) -> list[list[tuple[list[str], list[DataFrame]]]]:
    """(key, reference tables on it) of everything looked up for a line, in steps of like size."""
    confirmed = tables["supplier_confirmation"].select("document_number").distinct()
    pi_status = union_override([tables["pi_status"], tables["static_payment"]], DOCUMENT)
    approvals = _one(tables, "payrun_invoices", ["invoice_number"]).select("invoice_number", "line_payment_approval")
    steps = (
        ((LINE, ["shipments"], []),),
        ((LINE, ["l2_compliance", "l2_prd"], []),),
        ((LINE, ["l2_cprd", "l2_g2", "l2_qc"], []),),
        ((DOCUMENT, ["pi_invoices", "payrun_documents", "prepayment"],
          [pi_status, confirmed.withColumn("supplier_vp_check", F.lit("Available on VP"))]),),
        ((ARTICLE, ["transparency_requests", "packaging"], []),),
        ((["asin"], ["transparency_master"], []),
         (["memo"], ["memo_map"], []),
         (["vendor_id"], ["vendor_map"], []),
         (["item", "marketplace", "vendor_id"], ["compliance"], []),
         (["item", "marketplace"], ["master_data"], []),
         (["batch_id"], ["batches", "packing_lists", "fob", "g4", "spd_blockers", "ffw_status", "ffw_blockers"], []),
         (["invoice_number"], [], [approvals])),
    )
    out = []
    for step in steps:
        groups = []
        for keys, names, prepared in step:
            named = {name: next((v for v, whole in VISIBLE.items() if whole == keys and v in tables[name].columns), None) for name in names}
            for on in (keys, *[[v] for v in VISIBLE]):
                own = [name for name in names if ([named[name]] if named[name] else keys) == on]
                groups.append((on, [_one(tables, name, on) for name in own] + (prepared if on is keys else [])))
        out.append(groups)
    return out


def _line_attributes(df: DataFrame) -> DataFrame:
    """What follows from the line and its lookups alone."""
    for step in (attr.add_pending, attr.add_prd_decision):
        df = step(df)
    return _payment_attributes(df)


def _payment_attributes(df: DataFrame) -> DataFrame:
    """The part of them that group statuses are made of."""
    for step in (attr.add_line_payment_type, attr.add_invoice_submitted, attr.add_line_paid, attr.add_qc_stage):
        df = step(df)
    own = F.when(F.col("line_payment_status") == "Paid", "Pay").otherwise(attr.NOT_IN_SHEET)
    return df.withColumn("line_payment_approval", F.coalesce("line_payment_approval", own))


def enrich(lines: DataFrame, tables: Mapping[str, DataFrame], staging: str | None = None) -> DataFrame:
    """Line attributes and everything looked up for the line.

    With ``staging`` the lines and what is looked up are written there, and the result carries their row numbers.
    """
    if staging:
        return _line_attributes(enriched_rows(lines, tables, staging).read())
    df = lines.withColumns(_line_columns())
    for groups in _line_lookups(tables):
        for keys, sides in groups:
            df = lookup_many(df, keys, sides, DEFAULTS)
    # Attributes that follow from the line alone come after the lookups, so that they are not moved.
    return _line_attributes(df)


def enriched_rows(lines: DataFrame, tables: Mapping[str, DataFrame], staging: str) -> RowTables:
    """The lines stored in ``staging``, and beside them everything looked up for them, step by step."""
    rows = RowTables(lines, staging, ROW, _line_columns())
    for groups in _line_lookups(tables):
        rows.look_up(groups, DEFAULTS)
    return rows


#: What group statuses are made of.
GROUPED = ("batch_id", "shipment_number", "supplier_payment_terms", "invoice_number", "invoice_status", "line_payment_approval",
           "quality_control_status", "quality_control_date", "compliance_status")


def group_statuses(df: DataFrame | RowTables, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Batch and shipment statuses, and the telex state of the shipment.

    Of stored rows also what ``settle`` and ``own_up`` would look up by shipment and article.
    """
    groups = {"batch_id": "batch", "shipment_number": "inb"}
    more = {"batch_id": {**attr.qc_rollups(), **attr.compliance_rollup()}}
    sides = {name: _one(tables, name, ["shipment_number"]) for name in ("telex", "telex_supplier", "telex_ffw")}
    if isinstance(df, DataFrame):
        df = attr.add_group_statuses(df, groups, more)
        return attr.add_telex(df, [side.drop("telex_remark") for side in sides.values()])
    line = _payment_attributes(df.read(GROUPED))
    grouped = attr.add_group_statuses(line, groups, more, df.row)
    made = [name for name in grouped.columns if name not in line.columns]
    df.add(grouped.select(df.row, *made), dealt=True)
    telex = [sides["telex"].drop("telex_remark"), sides["telex_supplier"].withColumnRenamed("telex_remark", "_supplier_remark"),
             sides["telex_ffw"].withColumnRenamed("telex_remark", "_ffw_remark")]
    market = ["asin", "marketplace"]
    priorities = _one(tables, "priority_map", market).select(*market, F.col("priority").alias("_priority"))
    df.look_up([(["shipment_number"], telex), (market, [priorities])])
    return attr.add_telex(_line_attributes(df.read()))


#: The columns of a line that its lookups, attributes and group statuses are made of; all others are only shown.
LINE_READ = (
    *LINE, "marketplace", "po_vendor", "asin", "memo", "batch_id", "invoice_number", "quantity", "quantity_received", "item_rate_eur", "first_prd",
    "planned_prd", "prd_status", "prd", "accepted_prd", "supplier_payment_terms", "invoice_status", "quality_control_status",
    "quality_control_date", "confirmed_crd",
)


def status_lines(tables: Mapping[str, DataFrame], as_of, staging: str | None = None, shown: bool = True) -> DataFrame:
    """The open lines in ``tables['lines']`` with all their attributes, before stage and owner; without the columns that are
    only ``shown``, fewer are stored."""
    lines = tables["lines"] if shown else tables["lines"].select(*LINE_READ)
    df = enriched_rows(lines, tables, staging) if staging else enrich(lines, tables)
    return settle(group_statuses(df, tables), tables, as_of)


def settle(df: DataFrame, tables: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Attributes that need lookups and groups together."""
    df = attr.add_pickup_status(df, as_of)
    df = attr.add_shipping_status(attr.add_booking_status(df))
    df = attr.with_picked_compliance(attr.add_estimated_delivery(df, as_of))
    priorities = None if "_priority" in df.columns else _one(tables, "priority_map", ["asin", "marketplace"])
    df = attr.add_priority(attr.add_team(df), priorities)
    return attr.add_master_blocker(df)


def own_up(df: DataFrame, tables: Mapping[str, DataFrame], as_of, default_owner: str, inventory_owner: str) -> DataFrame:
    """Stage, sub-stage, blocker, owner and team."""
    status_dim = tables["status_map"]
    df = current_stage(df, stage_rules(as_of))
    df = sub_stage(add_pickup_blocker(df), status_dim, as_of)
    df = codes(df)
    found = "_supplier_remark" in df.columns
    df = l2_telex(df, *[] if found else [_one(tables, name, ["shipment_number"]) for name in ("telex_supplier", "telex_ffw")])
    roles = status_dim.select("sub_status", "accountable", "responsible")
    df = responsibility(l2_final(df), roles, tables["blockers_map"], default_owner)
    df = lookup(df, tables["reporting_map"], {"current_status": "status"},
                {"reporting_status": "reporting_status"}, {"reporting_status": ""})
    return team_of(poc(df, inventory_owner), tables["owner_teams"])


#: What a line's attributes, group statuses and ``settle`` set, and what ``own_up`` sets, besides what is looked up.
SETTLED = (
    "pending_units", "pending_value", "prd_delay_decision", "pi", "ci", "bl", "bl_days", "line_payment_type", "line_invoice_submission",
    "line_payment_status", "line_payment_approval", "qc_stage", "qc_pending", "supplier_telex", "sm_telex", "ffw_telex", "batch_pickup_status",
    "vp_booking_status", "shipping_status", "estimated_delivery_date", "batch_compliance", "team", "focus", "flag_d",
)
OWNED = (
    "current_status", "status_code", "pickup_blocker", "sub_status", "sub_code", "l2_telex", "l2_final_status", "accountable", "responsible",
    "final_responsibility", "reporting_status", "final_poc", "final_team",
)


def status_report(
    tables: Mapping[str, DataFrame], as_of, default_owner: str, inventory_owner: str,
    staging: str | None = None,
) -> DataFrame:
    """All inside columns of the report for the open lines in ``tables['lines']``."""
    owners = (default_owner, inventory_owner)
    if staging:
        # Each step reads and copies only the columns that its rules ask for; the whole lines are put together at the end.
        rows = enriched_rows(tables["lines"], tables, staging)
        df = settle(group_statuses(rows, tables), tables, as_of)
        rows.add(df.select(ROW, *SETTLED), dealt=True)
        rows.add(own_up(rows.read(), tables, as_of, *owners).select(ROW, *OWNED), dealt=True)
        df = rows.read().drop(ROW, "_priority", "_supplier_remark", "_ffw_remark")
    else:
        df = own_up(status_lines(tables, as_of), tables, as_of, *owners)
    return stage_flags(df, stage_rules(as_of)).withColumns({"days": F.lit(""), "days_bucket": F.lit("")})


def published(report: DataFrame) -> DataFrame:
    """The published columns under their shown names, coerced, without blank documents."""
    missing = [name for name in PUBLISHED if name not in report.columns]
    if missing:
        raise ValueError(f"columns to publish are missing: {', '.join(missing)}")
    return publish_view(report, PUBLISHED, PUBLISHED_DATES, PUBLISHED_NUMBERS, key="document_number")


STAGE = "_stage"


def _stage_number():
    return F.col("status_code").try_cast("int").cast("string")


def at_current_stage(dates: DataFrame, report: DataFrame, on: str = "line_key", id_column: str = "po_id") -> DataFrame:
    """The dates of the lines in ``report``, with the number of the stage that a line waits in as ``STAGE``.

    Of the timeline's long form only the rows of these stages need to be moved to the lines.
    """
    wanted = report.select(F.col(on).alias(id_column), _stage_number().alias(STAGE)).where(F.col(STAGE).isNotNull()).distinct()
    return dates.join(wanted, id_column)


def attach_stage_days(report: DataFrame, stages_long: DataFrame, on: str = "line_key", id_column: str = "po_id") -> DataFrame:
    """Days the line has been late in its current stage, from the timeline's long form.

    Joins the two halves of the tracker on line and stage number.
    """
    days = stages_long.select(
        F.col(id_column).alias(on), F.col("stage_id").alias(STAGE), F.col("delay_days").alias("_days")
    )
    keyed = report.drop("days").withColumn(STAGE, _stage_number())
    return lookup(keyed, days, [on, STAGE], {"days": "_days"}).drop(STAGE)
