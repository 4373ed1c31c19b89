"""Status report: enriched lines, group statuses, first pending stage, blocker and owner."""

from .attributes import (
    add_batch_compliance, add_booking_status, add_estimated_delivery, add_group_statuses,
    add_invoice_submitted, add_line_paid, add_line_payment_type, add_master_blocker, add_pending,
    add_pickup_status, add_prd_decision, add_priority, add_qc, add_shipping_status, add_team,
    add_telex,
)
from .full_view import full_columns, full_view
from .ladder import codes, current_stage, stage_flags, stage_rules, sub_stage, sub_stage_columns
from .ownership import add_pickup_blocker, l2_final, l2_telex, poc, responsibility, team_of
from .report import attach_stage_days, status_report

__all__ = [
    "add_batch_compliance", "add_booking_status", "add_estimated_delivery", "add_group_statuses",
    "add_invoice_submitted", "add_line_paid", "add_line_payment_type", "add_master_blocker",
    "add_pending", "add_pickup_blocker", "add_pickup_status", "add_prd_decision", "add_priority",
    "add_qc", "add_shipping_status", "add_team", "add_telex", "attach_stage_days", "codes",
    "current_stage", "full_columns", "full_view", "l2_final", "l2_telex", "poc", "responsibility", "stage_flags",
    "stage_rules", "status_report", "sub_stage", "sub_stage_columns", "team_of",
]
