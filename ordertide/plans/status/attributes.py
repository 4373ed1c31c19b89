"""Derived attributes of a purchase-order line, before the stage ladder.

Every function takes the clock as ``as_of`` where a rule needs one. Missing is always NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import as_timestamp, plus_days
from ...functions.text import bl_days, first_char, pct_of
from ...functions.values import is_value, present, to_number, yes_no
from ...operators.lookups import lookup_many, lookup_when
from ...operators.rollups import all_of, any_of, max_date, max_date_state, priority_of, roll_up, roll_up_all

NOT_IN_SHEET = "Not In Payment Sheet"
SHIPPED_STATES = ("In Transit", "Received", "Partially Received")
RELEASED, NOT_RELEASED = "Released", "Not Released"


def add_pending(df: DataFrame) -> DataFrame:
    """Outstanding units and their value in euros."""
    units = F.col("quantity").cast("long") - F.col("quantity_received").cast("long")
    return df.withColumns({"pending_units": units, "pending_value": F.col("item_rate_eur") * units})


def add_prd_decision(df: DataFrame) -> DataFrame:
    """Whether a production-ready date that moved has been agreed."""
    decision = (
        F.when(F.col("first_prd") <= plus_days("planned_prd", 7), "No Delay")
        .when(is_value("prd_status", "Auto-approved", "Approved by IM") | F.col("first_prd").isNull(), "Agreed")
        .when(F.col("prd") <= plus_days("accepted_prd", 7), "Agreed")
        .otherwise("SM Action Pending")
    )
    return df.withColumn("prd_delay_decision", decision)


def add_line_payment_type(df: DataFrame) -> DataFrame:
    """Payment shares read from the terms, and what the line is mainly paid by."""
    terms = F.col("supplier_payment_terms")
    shares = df.withColumns({
        "pi": pct_of(terms, "PI"), "ci": pct_of(terms, "CI"), "bl": pct_of(terms, "BL"),
        "bl_days": bl_days(terms),
    })
    kind = F.when(F.col("pi") == 100, "PI").when(F.col("pi") + F.col("ci") == 100, "CI").otherwise("BL")
    return shares.withColumn("line_payment_type", kind)


def add_invoice_submitted(df: DataFrame) -> DataFrame:
    done = present("invoice_number").isNotNull() | (F.col("bl_days") != 0)
    return df.withColumn("line_invoice_submission", F.when(done, "Submitted").otherwise("Not Submitted"))


def add_line_paid(df: DataFrame) -> DataFrame:
    paid = F.col("invoice_status") == "Bill:Paid In Full"
    return df.withColumn("line_payment_status", F.when(paid, "Paid").otherwise("Not Paid"))


def _payment_rollups(prefix: str) -> dict:
    return {
        f"{prefix}_payment_type": any_of("line_payment_type", "BL"),
        f"{prefix}_invoice_submission": any_of("line_invoice_submission", "Not Submitted"),
        f"{prefix}_payment_status": any_of("line_payment_status", "Not Paid"),
        f"{prefix}_payment_approval": priority_of("line_payment_approval", ("Reject", NOT_IN_SHEET), "Pay", "On Hold"),
    }


def add_group_statuses(
    df: DataFrame, prefixes: Mapping[str, str], more: Mapping[str, Mapping] | None = None, row: str | None = None,
) -> DataFrame:
    """Payment type, invoice, payment and approval of the line's batch and shipment (key column -> prefix).

    ``more`` are further rules by key column; ``row`` is as in ``roll_up_all``.
    """
    rules = {group: {**_payment_rollups(prefix), **(more or {}).get(group, {})} for group, prefix in prefixes.items()}
    return roll_up_all(df, rules, row)


def add_qc_stage(df: DataFrame) -> DataFrame:
    stage = to_number(first_char("quality_control_status"), "int", 1)
    return df.withColumn("qc_stage", stage).withColumn("qc_pending", yes_no(~F.col("qc_stage").isin(3, 6)))


def qc_rollups() -> dict:
    return {
        "batch_qc_pending": any_of("qc_pending", "Yes"),
        "max_qc_date": max_date("quality_control_date"),
        "max_qc_state": max_date_state("quality_control_date"),
    }


def add_qc(df: DataFrame) -> DataFrame:
    """Inspection stage of the line, open inspections and last inspection date of its batch."""
    return roll_up(add_qc_stage(df), "batch_id", qc_rollups())


def add_pickup_status(df: DataFrame, as_of) -> DataFrame:
    """Picked once the pick-up day has passed, or on any later evidence."""
    evidence = F.lit(False)
    for name in ("gate_in_date", "actual_shipping_date", "shipment_pickup_date", "actual_arrival_date", "actual_delivery_date"):
        evidence = evidence | F.col(name).isNotNull()
    evidence = evidence | is_value("shipment_status", *SHIPPED_STATES)
    today = F.to_date(as_timestamp(as_of))
    planned = F.to_date("actual_pickup_date") >= today
    picked = F.when(F.col("actual_pickup_date").isNull(), evidence).otherwise(~planned)
    return df.withColumn("batch_pickup_status", F.when(picked, "Picked").otherwise("Not Picked"))


def booking_status() -> Column:
    """Booking state of a batch row."""
    return (
        F.when(F.col("vp_booking_status") == "Cancelled", "Not Booked")
        .when(present("vp_booking_status").isNotNull() | present("freight_forwarder").isNotNull(), "Booked")
        .otherwise("Not Booked")
    )


def add_booking_status(df: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Booked when picked, else the batch's booking; ``batches`` is looked up unless given before."""
    if batches is not None:
        side = batches.select("batch_id", booking_status().alias("batch_booking"))
        df = lookup_many(df, ["batch_id"], [side])
    status = F.when(F.col("batch_pickup_status") == "Picked", "Booked").otherwise(
        F.coalesce("batch_booking", F.lit("Not Booked"))
    )
    return df.withColumn("vp_booking_status", status)


def add_shipping_status(df: DataFrame) -> DataFrame:
    evidence = is_value("shipment_status", *SHIPPED_STATES)
    for name in ("shipment_shipping_date", "actual_arrival_date", "actual_delivery_date", "actual_shipping_date"):
        evidence = evidence | F.col(name).isNotNull()
    shipped = F.col("shipment_number").isNotNull() & evidence
    return df.withColumn("shipping_status", F.when(shipped, "Shipped").otherwise("Not Shipped"))


# Days still to go to delivery after each milestone, latest milestone first.
DAYS_TO_DELIVERY = (
    ("actual_delivery_date", 0), ("actual_arrival_date", 15), ("shipment_shipping_date", 40),
    ("shipment_pickup_date", 50), ("gate_in_date", 45), ("actual_pickup_date", 50),
    ("confirmed_crd", 45), ("planned_prd", 55),
)
DAYS_WITHOUT_MILESTONE = 100


def add_estimated_delivery(df: DataFrame, as_of) -> DataFrame:
    """Delivery date, or an estimate from the last milestone reached."""
    steps = [plus_days(name, days) for name, days in DAYS_TO_DELIVERY]
    estimate = F.coalesce(*steps, plus_days(as_timestamp(as_of), DAYS_WITHOUT_MILESTONE))
    return df.withColumn("estimated_delivery_date", estimate)


def add_telex(df: DataFrame, sources: list[DataFrame] | None = None) -> DataFrame:
    """Telex release by forwarder, by supply manager and by supplier; each counts as released once
    the party before it has released.

    ``sources`` hold one row per shipment_number with ``telex_ffw_date``, ``telex_supplier_date``,
    ``ffw_sheet``, ``supplier_sheet``; leave out when these columns are already present.
    """
    if sources:
        df = lookup_many(df, ["shipment_number"], sources)
    ffw = F.col("telex_ffw_date").isNotNull() | is_value("ffw_sheet", RELEASED)
    manager = ffw | F.col("telex_supplier_date").isNotNull()
    supplier = manager | is_value("supplier_sheet", RELEASED)
    delivered = is_value("substatus", "Delivered")

    def status(released: Column) -> Column:
        return (
            F.when(delivered, RELEASED).when(F.col("shipment_number").isNull(), "Not in INB Sheet")
            .when(released, RELEASED).otherwise(NOT_RELEASED)
        )

    return df.withColumns({
        "supplier_telex": status(supplier), "sm_telex": status(manager), "ffw_telex": status(ffw),
    })


def add_team(df: DataFrame) -> DataFrame:
    """Team of the vendor; Chinese vendors selling to the US form their own team."""
    lane = (F.col("vendor_country") == "China") & (F.col("marketplace") == "US")
    return df.withColumn("team", F.when(lane, "CN->US").otherwise(F.coalesce("vendor_team", F.lit(""))))


def add_priority(df: DataFrame, priorities: DataFrame | None) -> DataFrame:
    """Priority of the article in its market, only for the CN->US lane; without ``priorities`` it is in ``_priority``."""
    lane, other = F.col("team") == "CN->US", F.lit("Priority 3")
    if priorities is None:
        return df.withColumn("focus", F.when(lane, F.coalesce("_priority", other)).otherwise(other)).drop("_priority")
    return lookup_when(df, lane, priorities, ["asin", "marketplace"], ("focus", "priority"), "Priority 3")


def add_batch_compliance(df: DataFrame) -> DataFrame:
    """Approved once picked or when every line of the batch is approved."""
    rolled = roll_up(df, "batch_id", compliance_rollup())
    return with_picked_compliance(rolled)


def compliance_rollup() -> dict:
    return {"batch_compliance": all_of("compliance_status", "Approved", "Pending Approval")}


def with_picked_compliance(df: DataFrame) -> DataFrame:
    picked = F.col("batch_pickup_status") == "Picked"
    return df.withColumn("batch_compliance", F.when(picked, "Approved").otherwise(F.col("batch_compliance")))


def add_master_blocker(df: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Master-data blocker of the article in its market, and whether it blocks the line."""
    if master is not None:
        df = lookup_many(df, ["item", "marketplace"], [master], {"md_blocker": "No Blocker"})
    blocked = (F.col("batch_pickup_status") != "Picked") & (F.col("md_blocker") != "No Blocker")
    return df.withColumn("flag_d", yes_no(blocked))
