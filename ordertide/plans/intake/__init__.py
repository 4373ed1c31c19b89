"""From raw tables and hand-kept trackers to the inputs of the reports."""

from .assemble import report_inputs
from .contracts import CONTRACTS, Contract, admitted, drift, read_text
from .trackers import TRACKERS, Tracker, read_trackers, report_trackers, tracker_rows

__all__ = [
    "CONTRACTS", "TRACKERS", "Contract", "Tracker", "admitted", "drift", "read_text", "read_trackers", "report_inputs",
    "report_trackers", "tracker_rows",
]
