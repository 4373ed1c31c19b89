"""The stage ladder: which stage a line is waiting in.

The ladder is data: a list of (code, name, condition). Flags, current stage and sub-stage are
read off the same list in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import as_timestamp, plus_days
from ...functions.text import prefix
from ...functions.values import is_value, yes_no
from ...operators.lookups import sub_text
from .attributes import NOT_IN_SHEET, RELEASED

# Stage codes and names, in ladder order.
STAGES = {
    "A": "A. Anti PO Line",
    "B": "B. Compliance Blocked",
    "C": "C. Shipped",
    "01": "01. PO Approval Pending",
    "02": "02. Supplier Confirmation Pending",
    "03": "03. PI Upload Pending",
    "04": "04. PI Approval Pending",
    "05": "05. PI Payment Pending",
    "06": "06. Packaging Pending",
    "07": "07. Transparency Label Pending",
    "08": "08. PRD Pending",
    "09": "09. Under Production",
    "10": "10. PRD Confirmation Pending",
    "11": "11. IM Sign-Off Pending",
    "12": "12. Ready for Batching Pending",
    "13": "13. Batch Creation Pending",
    "14": "14. SM Sign-Off Pending",
    "15": "15. CI Approval Pending",
    "16": "16. CI Payment Pending",
    "17": "17. QC Schedule Pending",
    "18": "18. FFW Booking Missing",
    "19": "19. Supplier Pickup Date Pending",
    "20": "20. Pre Pickup Check",
    "21": "21. FOB Pickup Pending",
    "22": "22. Non FOB Pickup Pending",
    "23": "23. INB Creation Pending",
    "24": "24. Mark In-Transit Pending",
    "25": "25. BL Approval Pending",
    "26": "26. BL Payment Pending - In Transit",
    "27": "27. BL Payment Pending - Arrived",
    "28": "28. Telex Release Pending",
    "29": "29. Stock Delivery Pending",
    "30": "30. Stock Receiving Pending",
    "31": "31. Dispute - PO Closing Pending",
}
UPLOAD_PENDING = "03. PI Upload Pending"
RECEIVED_STATES = ("Received", "Partially Received")


@dataclass(frozen=True)
class StageRule:
    code: str
    name: str
    condition: Column


def _is(name: str, *values: str) -> Column:
    return is_value(name, *values)


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def stage_rules(as_of) -> list[StageRule]:
    """The ladder for one clock reading. Conditions are never NULL."""
    now = as_timestamp(as_of)
    unpicked = ~_is("batch_pickup_status", "Picked")
    no_advance = _sure(F.col("pi") == 0)
    not_submitted = _is("ns_pi_status", "Not Submitted")
    upload = not_submitted & ~no_advance & _is("vp_pi_status", UPLOAD_PENDING)
    received_some = F.coalesce(F.col("quantity_received") != 0, F.lit(True))
    settled = _sure(F.col("quantity_received") == 100) & _is("batch_payment_status", "Paid")
    no_prd = F.col("prd").isNull()
    producing = no_prd | _sure(plus_days("prd", -21) > now)
    credit_batch, credit_ship = _is("batch_payment_type", "BL"), _is("inb_payment_type", "BL")
    qc_open = ~_is("batch_qc_pending", "No")
    fob = _is("batch_incoterms", "FOB")
    undelivered = ~_is("substatus", "Delivered")
    arrived = F.col("actual_arrival_date").isNotNull()
    credit_due = ~_is("inb_payment_status", "Paid") & credit_ship & undelivered
    booked_by_buyer = _is("batch_incoterms", "DAP", "DDP")
    conditions = {
        "A": unpicked & _is("considered_anti_po", "Yes"),
        "B": unpicked & _is("compliance_status", "Blocked", "Missing"),
        "C": unpicked & _is("shipping_status", "Shipped"),
        "01": unpicked & _is("final_status", "Pending Supervisor Approval", "Rejected By Supervisor"),
        "02": unpicked & ~_is("supplier_confirmation_status", "Confirmed"),
        "03": unpicked & upload,
        "04": unpicked & ~no_advance & ~_sure(F.col("vp_pi_status").startswith("05")) & not_submitted,
        "05": unpicked & (
            _is("pi_payment_status", "Yes")
            | (~settled & ~_is("pi_payment_status", "Paid In Full") & received_some)
        ),
        "06": unpicked & _is("packaging_pending", "Yes"),
        "07": unpicked & ~_is("transparency_check", "No") & ~_is("transparency_pending", "No"),
        "08": unpicked & no_prd,
        "09": unpicked & producing,
        "10": unpicked & (producing | _sure(plus_days("prd", -18) > now) | ~_is("prd_reconfirmation", "Yes")),
        "11": unpicked & ~(_is("im_line_signoff", "Yes") & _is("compliance_status", "Approved")),
        "12": unpicked & ~_is("production_status", "Ready for batching", "Cargo Picked(SM)"),
        "13": unpicked & F.col("batch_id").isNull(),
        "14": unpicked & ~_is("batch_sign_off", "Signed-Off"),
        "15": unpicked & ~_is("batch_invoice_submission", "Submitted") & ~credit_batch,
        "16": unpicked & ~_is("batch_payment_status", "Paid") & ~credit_batch,
        "17": unpicked & qc_open & (
            _is("max_qc_state", "Not Scheduled") | _sure(F.col("max_qc_date") > plus_days(now, -1))
        ),
        "18": unpicked & ~booked_by_buyer & ~_is("vp_booking_status", "Booked"),
        "19": unpicked & (F.col("spd").isNull() | (F.col("spd") > plus_days(now, 7))),
        "20": unpicked & (
            _is("batch_qc_pending", "Yes") | (~fob & _sure(F.col("spd") > now)) | (fob & F.col("fob_date").isNull())
        ),
        "21": unpicked & (fob | booked_by_buyer),
        "22": unpicked,
        "23": F.col("shipment_number").isNull(),
        "24": _is("shipment_status", "To Be Shipped"),
        "25": ~_is("inb_invoice_submission", "Submitted") & credit_ship,
        "26": credit_due & ~arrived,
        "27": credit_due,
        "28": _is("shipment_method", "Ocean") & undelivered & (~arrived | ~_is("ffw_telex", RELEASED)),
        "29": undelivered,
        "30": ~_is("shipment_status", *RECEIVED_STATES),
        "31": _is("shipment_status", *RECEIVED_STATES),
    }
    return [StageRule(code, name, conditions[code]) for code, name in STAGES.items()]


def flag_column(code: str) -> str:
    return f"flag_{code.lower()}"


def stage_flags(df: DataFrame, rules: list[StageRule]) -> DataFrame:
    """One Yes/No column per stage."""
    return df.withColumns({flag_column(rule.code): yes_no(rule.condition) for rule in rules})


def _first_pending(rules: list[StageRule]) -> list[StageRule]:
    """Ladder order with the closing stage asked first."""
    return [rule for rule in rules if rule.code == "31"] + [rule for rule in rules if rule.code != "31"]


def current_stage(df: DataFrame, rules: list[StageRule], from_flags: bool = False) -> DataFrame:
    """The first pending stage and its code; missing where nothing is pending."""
    ordered = _first_pending(rules)

    def pending(rule: StageRule) -> Column:
        return F.col(flag_column(rule.code)) == "Yes" if from_flags else rule.condition

    return df.withColumns({
        "current_status": F.coalesce(*[F.when(pending(rule), rule.name) for rule in ordered]),
        "status_code": F.coalesce(*[F.when(pending(rule), rule.code) for rule in ordered]),
    })


def _by_value(column: str, choices: dict[str, str], other: str | None = None) -> Column:
    result = F.lit(other).cast("string")
    for value, code in reversed(choices.items()):
        result = F.when(F.col(column) == value, code).otherwise(result)
    return result


def _either(test: Column, yes: str, no: str) -> Column:
    return F.when(_sure(test), yes).otherwise(no)


def _approval(column: str, stage: str) -> Column:
    return _by_value(column, {
        "Pay": f"{stage}a", "On Hold": f"{stage}b", "Reject": f"{stage}c", NOT_IN_SHEET: f"{stage}d",
    })


def sub_codes(as_of) -> dict[str, Column]:
    """Per stage with numbered sub-stages, the code of the one that applies."""
    now = as_timestamp(as_of)
    today = F.to_date(now)
    amazon = F.col("wh_type") == "AMZ"
    fob_day = F.to_date("fob_date")
    return {
        "01": _by_value("final_status", {"Pending Supervisor Approval": "01a", "Rejected By Supervisor": "01b"}),
        "02": F.when(F.col("supplier_vp_check") == "Not Available on VP", "02a").otherwise(
            _by_value("supplier_confirmation_status", {"Pending Confirmation": "02b", "Rejected": "02c"})
        ),
        "05": _by_value("pi_payment_status", {"Pay": "05a", "On Hold": "05b", "Reject": "05c"}, "05d"),
        "06": F.lit("06b"),
        "07": _either(F.col("transparency_pending") == "Missing", "07a", "07b"),
        "09": F.when(F.col("prd") <= plus_days("planned_prd", 7), "09a").otherwise(
            _by_value("prd_delay_decision", {"SM Action Pending": "09b", "IM Action Pending": "09c"}, "09d")
        ),
        "10": _either(F.col("prd_reconfirmation") == "Yes", "10b", "10a"),
        "11": _either(F.col("compliance_status") == "Approved", "11b", "11a"),
        "13": _either(amazon, "13a", "13b"),
        "16": _approval("batch_payment_approval", "16"),
        "17": _either(F.col("max_qc_state") == "Not Scheduled", "17a", "17b"),
        "19": F.when(F.col("spd").isNotNull(), "19b").otherwise(
            _either(F.col("l2_spd").isin("Not in SPD Sheet", "No SPD Blocker Mentioned"), "19a", "19c")
        ),
        "20": F.when(F.col("batch_qc_pending") == "Yes", "20a").otherwise(
            _either((F.col("batch_incoterms") == "FOB") & F.col("fob_date").isNull(), "20b", "20c")
        ),
        "21": F.when(F.col("batch_incoterms").isin("DDP", "DAP") | (fob_day < today), "21a").otherwise(
            _either(fob_day < F.date_add(today, 2), "21b", "21c")
        ),
        "22": F.when(F.col("actual_pickup_date").isNotNull(), "22a").otherwise(
            _either(F.col("pickup_blocker") != "No", "22b", "22c")
        ),
        "23": _either(F.col("gate_in_date").isNull(), "23a", "23b"),
        "24": _either(F.col("shipping_status") == "Not Shipped", "24a", "24b"),
        "25": _either(F.col("shipment_shipping_date") > plus_days(now, -5), "25a", "25b"),
        "26": _approval("inb_payment_approval", "26"),
        "27": _approval("inb_payment_approval", "27"),
        "28": F.coalesce(*[
            F.when(F.col("actual_arrival_date").isNull() == waiting, F.when(F.col(telex) == "Not Released", code))
            for waiting, telex, code in (
                (True, "supplier_telex", "28a"), (True, "sm_telex", "28b"), (True, "ffw_telex", "28c"),
                (False, "supplier_telex", "28d"), (False, "sm_telex", "28e"), (False, "ffw_telex", "28f"),
            )
        ], F.lit("28g")),
        "29": _either(amazon, "29a", "29b"),
        "30": _either(amazon, "30a", "30b"),
        "31": _either(amazon, "31a", "31b"),
    }


# Every numbered sub-stage code.
SUB_CODES = (
    "01a", "01b", "02a", "02b", "02c", "05a", "05b", "05c", "05d", "06b", "07a", "07b",
    "09a", "09b", "09c", "09d", "10a", "10b", "11a", "11b", "13a", "13b", "16a", "16b", "16c", "16d",
    "17a", "17b", "19a", "19b", "19c", "20a", "20b", "20c", "21a", "21b", "21c", "22a", "22b", "22c",
    "23a", "23b", "24a", "24b", "25a", "25b", "26a", "26b", "26c", "26d", "27a", "27b", "27c", "27d",
    "28a", "28b", "28c", "28d", "28e", "28f", "28g", "29a", "29b", "30a", "30b", "31a", "31b",
)


def sub_stage(df: DataFrame, status_dim: DataFrame, as_of) -> DataFrame:
    """The sub-status of the current stage.

    Numbered sub-stages take their text from ``status_dim`` by code. Stages 04, 06 and 14 show the
    text their own source gives; the others repeat the stage name.
    """
    stage, chosen = F.col("status_code"), F.lit(None).cast("string")
    for code, column in reversed(sub_codes(as_of).items()):
        chosen = F.when(stage == code, column).otherwise(chosen)
    own = (
        F.when(stage == "04", F.col("vp_pi_status"))
        .when(stage == "06", F.col("packaging_l2"))
        .when(stage == "14", F.col("batch_sign_off"))
        .when(stage.isin("A", "B", "C", "03", "08", "12", "15", "18"), F.col("current_status"))
    )
    keyed = df.withColumns({"_own": own, "sub_key": F.when(own.isNull(), chosen)})
    texts = status_dim.select("code", F.col("sub_status").alias("_text"))
    found = sub_text(keyed, texts, "sub_key", "_text", "_text")
    return found.withColumn("sub_status", F.coalesce("_own", "_text")).drop("_own", "_text", "sub_key")


def sub_stage_columns(df: DataFrame) -> DataFrame:
    """The wide form: per stage its sub-status, ``NA`` unless it is the current stage."""
    return df.withColumns({
        f"sub_{code.lower()}": F.when(F.col("status_code") == code, F.col("sub_status")).otherwise(F.lit("NA"))
        for code in STAGES
    })


def codes(df: DataFrame) -> DataFrame:
    """Codes read from the status texts: before the first dot, and digits with their letter."""
    return df.withColumns({
        "status_code": prefix("current_status", r"^([^\.]+)"),
        "sub_code": prefix("sub_status", r"^(\d+[a-z]?)"),
    })
