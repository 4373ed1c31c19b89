"""The stage ladder on hand-made lines: a clean line, then one cause at a time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import status_tables
from helpers import plan
from ordertide.plans.status import attach_stage_days, current_stage, stage_rules
from ordertide.plans.status.attributes import add_pickup_status, add_shipping_status, add_telex
from ordertide.plans.status.ladder import STAGES, SUB_CODES, sub_codes

AS_OF = "2025-06-01 12:00:00"
T0 = datetime(2025, 5, 1)
LATER = datetime(2025, 8, 1)

# An unpicked line with nothing pending before stage 22.
CLEAN = {
    "batch_pickup_status": "Not Picked", "considered_anti_po": "No", "compliance_status": "Approved",
    "shipping_status": "Not Shipped", "final_status": "Open", "supplier_confirmation_status": "Confirmed",
    "ns_pi_status": "Paid In Full", "pi": 30.0, "vp_pi_status": "05a. Approved", "pi_payment_status": "Pay",
    "quantity_received": 0, "batch_payment_status": "Paid", "packaging_pending": "No", "transparency_check": "No",
    "transparency_pending": "No", "prd": T0, "prd_reconfirmation": "Yes", "im_line_signoff": "Yes",
    "production_status": "Ready for batching", "batch_id": "B1", "batch_sign_off": "Signed-Off",
    "batch_invoice_submission": "Submitted", "batch_payment_type": "PI", "batch_qc_pending": "No",
    "max_qc_state": "Scheduled", "max_qc_date": T0, "batch_incoterms": "EXW", "vp_booking_status": "Booked",
    "spd": T0, "fob_date": T0, "shipment_number": "S1", "shipment_status": "In Transit",
    "inb_invoice_submission": "Submitted", "inb_payment_type": "BL", "inb_payment_status": "Paid",
    "substatus": "Open", "actual_arrival_date": T0, "shipment_method": "Air", "ffw_telex": "Released",
}
PICKED = {"batch_pickup_status": "Picked"}
CASES = [
    ("A", {"considered_anti_po": "Yes"}), ("B", {"compliance_status": "Blocked"}), ("C", {"shipping_status": "Shipped"}),
    ("01", {"final_status": "Rejected By Supervisor"}), ("02", {"supplier_confirmation_status": None}),
    ("03", {"ns_pi_status": "Not Submitted", "vp_pi_status": "03. PI Upload Pending"}),
    ("04", {"ns_pi_status": "Not Submitted", "vp_pi_status": "04a. SM Review Pending"}),
    ("05", {"pi_payment_status": "Yes"}), ("05", {"quantity_received": 5}), ("06", {"packaging_pending": "Yes"}),
    ("07", {"transparency_check": "Yes", "transparency_pending": "Missing"}), ("08", {"prd": None}),
    ("09", {"prd": LATER}), ("10", {"prd": datetime(2025, 6, 21)}), ("10", {"prd_reconfirmation": None}),
    ("11", {"im_line_signoff": "No"}), ("12", {"production_status": "Planned"}), ("13", {"batch_id": None}),
    ("14", {"batch_sign_off": "14a. Documents Missing"}), ("15", {"batch_invoice_submission": "Not Submitted"}),
    ("16", {"batch_payment_status": "Not Paid"}),
    ("17", {"batch_qc_pending": "Yes", "max_qc_state": "Not Scheduled", "max_qc_date": None}),
    ("18", {"vp_booking_status": "Not Booked"}), ("19", {"spd": None}), ("19", {"spd": LATER}),
    ("20", {"spd": datetime(2025, 6, 5)}), ("20", {"batch_incoterms": "FOB", "fob_date": None}),
    ("21", {"batch_incoterms": "FOB"}), ("22", {}),
    ("23", {**PICKED, "shipment_number": None}), ("24", {**PICKED, "shipment_status": "To Be Shipped"}),
    ("25", {**PICKED, "inb_invoice_submission": "Not Submitted"}),
    ("26", {**PICKED, "inb_payment_status": "Not Paid", "actual_arrival_date": None}),
    ("27", {**PICKED, "inb_payment_status": "Not Paid"}),
    ("28", {**PICKED, "shipment_method": "Ocean", "ffw_telex": "Not Released"}),
    ("28", {**PICKED, "shipment_method": "Ocean", "actual_arrival_date": None}), ("29", PICKED),
    ("30", {**PICKED, "substatus": "Delivered"}), ("31", {"shipment_status": "Received", "considered_anti_po": "Yes"}),
]
TYPES = {"pi": "double", "quantity_received": "long", "prd": "timestamp", "max_qc_date": "timestamp", "spd": "timestamp",
         "fob_date": "timestamp", "actual_arrival_date": "timestamp"}


@pytest.fixture(scope="module")
def ladder(spark):
    schema = ", ".join(f"{name} {TYPES.get(name, 'string')}" for name in CLEAN)
    data = [(at, *{**CLEAN, **change}.values()) for at, (_, change) in enumerate(CASES)]
    df = spark.createDataFrame(data, f"at int, {schema}")
    return {row.at: row for row in current_stage(df, stage_rules(AS_OF)).collect()}


@pytest.mark.parametrize("at", range(len(CASES)))
def test_first_pending_stage(ladder, at):
    code, _ = CASES[at]
    assert ladder[at].status_code == code
    assert ladder[at].current_status == STAGES[code]


def test_every_stage_is_covered():
    assert {code for code, _ in CASES} == set(STAGES)


def test_qc_in_the_past_lets_stage_17_pass(spark):
    schema = ", ".join(f"{name} {TYPES.get(name, 'string')}" for name in CLEAN)
    df = spark.createDataFrame([tuple({**CLEAN, "batch_qc_pending": "Yes"}.values())], schema)
    assert current_stage(df, stage_rules(AS_OF)).first().status_code == "20"


def test_sub_codes_are_listed():
    assert set(sub_codes(AS_OF)) <= set(STAGES)
    assert {code[:2] for code in SUB_CODES} == set(sub_codes(AS_OF))


def test_pickup_needs_evidence(spark):
    names = ("gate_in_date", "actual_shipping_date", "shipment_pickup_date", "actual_arrival_date", "actual_delivery_date", "actual_pickup_date")
    base = {name: None for name in names}
    lines = [{**base}, {**base, "gate_in_date": T0}, {**base, "actual_pickup_date": LATER}, {**base, "actual_pickup_date": T0},
             {**base, "actual_pickup_date": datetime(2025, 6, 1)}]
    df = spark.createDataFrame([(at, None, *line.values()) for at, line in enumerate(lines)],
                               "at int, shipment_status string, " + ", ".join(f"{name} timestamp" for name in names))
    found = [r.batch_pickup_status for r in add_pickup_status(df, AS_OF).orderBy("at").collect()]
    assert found == ["Not Picked", "Picked", "Not Picked", "Picked", "Not Picked"]


def test_shipment_without_evidence_is_not_shipped(spark):
    df = spark.createDataFrame([("S1", "Planned", None), ("S1", "In Transit", None), (None, "In Transit", T0), ("S1", None, T0)],
                               "shipment_number string, shipment_status string, actual_arrival_date timestamp")
    for name in ("shipment_shipping_date", "actual_delivery_date", "actual_shipping_date"):
        df = df.withColumn(name, F.lit(None).cast("timestamp"))
    assert [r.shipping_status for r in add_shipping_status(df).collect()] == ["Not Shipped", "Shipped", "Not Shipped", "Shipped"]


def test_telex_cascades_from_forwarder_to_supplier(spark):
    df = spark.createDataFrame(
        [(1, "S", "Open", T0, None, None, None), (2, "S", "Open", None, T0, None, None), (3, "S", "Open", None, None, None, "Released"),
         (4, "S", "Open", None, None, "Released", None), (5, None, "Open", None, None, None, None), (6, None, "Delivered", None, None, None, None)],
        "at int, shipment_number string, substatus string, telex_ffw_date timestamp, telex_supplier_date timestamp,"
        " ffw_sheet string, supplier_sheet string")
    found = [(r.ffw_telex, r.sm_telex, r.supplier_telex) for r in add_telex(df).orderBy("at").collect()]
    yes, no, out = "Released", "Not Released", "Not in INB Sheet"
    assert found == [(yes,) * 3, (no, yes, yes), (no, no, yes), (yes,) * 3, (out,) * 3, (yes,) * 3]


def test_days_in_current_stage(spark):
    report = spark.createDataFrame([("a", "04"), ("b", "B"), ("c", "12")], "line_key string, status_code string").withColumn("days", F.lit(""))
    long = spark.createDataFrame([("a", "4", 9), ("a", "5", 2), ("c", "12", -1)], "po_id string, stage_id string, delay_days long")
    found = {r.line_key: r.days for r in attach_stage_days(report, long).collect()}
    assert found == {"a": 9, "b": None, "c": -1}


def test_the_log_is_moved_without_its_visible_keys(spark, sf):
    text = plan(status_tables.po_lines(spark, sf))
    assert "document_number" in text and "document_number" not in text[text.index("Window"):]
