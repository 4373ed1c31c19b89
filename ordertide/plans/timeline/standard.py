"""The standard 31-stage configuration of a purchase-order line."""

from __future__ import annotations

from .config import ProcessFlow, Stage, validate

# Id, name, actual date, predecessors, fallback, lead time in days, on the critical
# path, process type, owning team, stages running in parallel.
STANDARD_STAGES = (
    ("1", "01. PO Approval Pending", "po_approval_date", None,
     "po_created_date", 2, True, "approval", "Procurement", ()),
    ("2", "02. Supplier Confirmation Pending", "supplier_confirmation_date", "['1']",
     "", 3, True, "confirmation", "Procurement", ()),
    ("3", "03. PI Upload Pending", "pi_invoice_approval_date", "['2']",
     "", 1, True, "documentation", "Procurement", ()),
    ("4", "04. PI Approval Pending", "pi_invoice_approval_date", "['3']",
     "max(supplier_confirmation_date, add_days(po_approval_date, 5))", 2, True, "approval", "Finance", ()),
    ("5", "05. PI Payment Pending", "pi_payment_date", "['4']",
     "max(pi_invoice_approval_date, add_days(supplier_confirmation_date, 2))", 5, True, "payment", "Finance", ()),
    ("6", "06. Packaging Pending", "", "cond(pi_applicable==1, ['5'], ['2'])",
     "max(pi_payment_date, add_days(pi_invoice_approval_date, 5))", 3, False, "preparation", "Operations", ("7", "8")),
    ("7", "07. Transparency Label Pending", "", "cond(pi_applicable==1, ['5'], ['2'])",
     "max(pi_payment_date, add_days(pi_invoice_approval_date, 5))", 2, False, "preparation", "Operations", ("6", "8")),
    ("8", "08. PRD Pending", "receive_first_prd_date", "cond(pi_applicable==1, ['5'], ['2'])",
     "max(receive_first_prd_date, add_days(pi_payment_date, 2))", 2, False, "confirmation", "Finance", ("6", "7")),
    ("9", "09. Under Production", "", "['8']",
     "max(receive_first_prd_date, add_days(pi_payment_date, 2), add_days(supplier_confirmation_date, 3))",
     7, True, "production", "Supplier", ()),
    ("10", "10. PRD Confirmation Pending", "prd_reconfirmed_date", "",
     "max(prd_reconfirmed_date, add_days(receive_first_prd_date, plt -21),stage_8+plt-21)",
     1, True, "confirmation", "Procurement", ()),
    ("11", "11. IM Sign-Off Pending", "po_im_date_value", "['10']",
     "max(po_im_date_value, add_days(prd_reconfirmed_date, 1))", 2, True, "approval", "Operations", ()),
    ("12", "12. Ready for Batching Pending", "po_sm_date_value", "['11']",
     "max(po_im_date_value, add_days(prd_reconfirmed_date, 2))", 1, True, "preparation", "Operations", ()),
    ("13", "13. Batch Creation Pending", "batch_created_ts", "['12']",
     "max(po_sm_date_value, add_days(po_im_date_value, 2))", 1, True, "processing", "Operations", ()),
    ("14", "14. SM Sign-Off Pending", "sm_signoff_ts", "['13']",
     "max(batch_created_ts, add_days(po_sm_date_value, 1))", 2, True, "approval", "Operations", ()),
    ("15", "15. CI Approval Pending", "ci_invoice_approval_date", "cond(ci_applicable==1, ['14'], [])",
     "None", 1, True, "approval", "Finance", ()),
    ("16", "16. CI Payment Pending", "ci_payment_date", "['15']",
     "None", 3, True, "payment", "Finance", ()),
    ("17", "17. QC Schedule Pending", "qc_schedule_date", "cond(ci_applicable==1,['16'],['14'])",
     "None", 2, True, "scheduling", "Quality", ()),
    ("18", "18. FFW Booking Missing", "ffw_booking_ts", "cond(ci_applicable==1, ['14','16','17'], ['17'])",
     "max(ffw_booking_ts, add_days(qc_schedule_date, 2))", 1, True, "booking", "Logistics", ()),
    ("19", "19. Supplier Pickup Date Pending", "spd_ts", "['18']",
     "max(spd_ts, add_days(ffw_booking_ts, 1))", 3, True, "scheduling", "Logistics", ()),
    ("20", "20. Pre Pickup Check", "stock_pickup_date", "['19']",
     "", 1, True, "inspection", "Quality", ()),
    ("21", "21. FOB Pickup Pending", "actual_cargo_pick_up_date", "['20']",
     "max(actual_cargo_pick_up_date, add_days(stock_pickup_date, 1))", 2, True, "pickup", "Logistics", ("22",)),
    ("22", "22. Non FOB Pickup Pending", "actual_cargo_pick_up_date", "['20']",
     "max(actual_cargo_pick_up_date, add_days(stock_pickup_date, 1))", 2, False, "pickup", "Logistics", ("21",)),
    ("23", "23. INB Creation Pending", "shipment_creation_date", "['21']",
     "max(shipment_creation_date, add_days(actual_cargo_pick_up_date, 2))", 1, True, "documentation", "Logistics", ()),
    ("24", "24. Mark In-Transit Pending", "shipment_in_transit_date", "['23']",
     "max(shipment_in_transit_date, add_days(shipment_creation_date, 1))", 3, True, "tracking", "Logistics", ()),
    ("25", "25. BL Approval Pending", "bi_invoice_approval_date", "['24']",
     "max(bi_invoice_approval_date, add_days(shipment_in_transit_date, 3))", 1, True, "approval", "Finance", ()),
    ("26", "26. BL Payment Pending - In Transit", "bi_payment_date", "['25']",
     "max(bi_payment_date, add_days(bi_invoice_approval_date, 1))", 5, True, "payment", "Finance", ("27",)),
    ("27", "27. BL Payment Pending - Arrived", "actual_arrival_date", "['25']",
     "max(bi_payment_date, add_days(actual_arrival_date, 1))", 3, False, "payment", "Finance", ("26",)),
    ("28", "28. Telex Release Pending", "ffwp_telex_release_date", "['26', '27']",
     "max(ffwp_telex_release_date, add_days(bi_payment_date, 3))", 1, True, "release", "Finance", ()),
    ("29", "29. Stock Delivery Pending", "shipment_stock_delivery_date", "['28']",
     "max(shipment_stock_delivery_date, add_days(ffwp_telex_release_date, 1))", 2, True, "delivery", "Logistics", ()),
    ("30", "30. Stock Receiving Pending", "item_receipt_date", "['29']",
     "max(item_receipt_date, add_days(shipment_stock_delivery_date, 2))", 1, True, "receiving", "Warehouse", ()),
    ("31", "31. Dispute - PO Closing Pending", "", "['30']",
     "max(actual_delivery_date, add_days(item_receipt_date, 1))", 2, True, "closure", "Finance", ()),
)

# The date columns of the timeline input, in source order.
TIMELINE_DATES = (
    "po_created_date", "po_approval_date", "supplier_confirmation_date",
    "pi_invoice_approval_date", "pi_payment_date", "receive_first_prd_date",
    "prd_reconfirmed_date", "po_im_date_value", "po_sm_date_value",
    "batch_created_ts", "sm_signoff_ts", "ci_invoice_approval_date",
    "ci_payment_date", "qc_schedule_date", "ffw_booking_ts", "spd_ts",
    "stock_pickup_date", "shipment_creation_date", "shipment_in_transit_date",
    "bi_invoice_approval_date", "bi_payment_date", "ffwp_telex_release_date",
    "shipment_stock_delivery_date", "item_receipt_date", "actual_cargo_pick_up_date",
    "actual_shipping_date", "actual_arrival_date", "actual_delivery_date",
)


def standard_stages() -> list[Stage]:
    stages = [
        Stage(stage_id, name, actual or None, preceding or None, fallback or None, lead,
              ProcessFlow(critical, kind, team, parallel))
        for stage_id, name, actual, preceding, fallback, lead, critical, kind, team, parallel in STANDARD_STAGES
    ]
    validate(stages)
    return stages
