"""Stage timeline: a date, a delay and an owner for every stage of a purchase-order line."""

from .config import ProcessFlow, Stage, load_stages, stage_dim, stages_from_dict, topological_order, validate
from .delays import stage_delay
from .documents import documents, flat_tables, read_documents
from .engine import timeline
from .explain import explain_stages, with_stage_dim
from .failures import timeline_or_failures
from .reports import delay_report, nested_results, stage_matrix, stage_wide, stages_long
from .standard import TIMELINE_DATES, standard_stages
from .summaries import global_delay, insights, method_counts, po_delay_summary, team_delay, worst_team

__all__ = [
    "ProcessFlow", "Stage", "TIMELINE_DATES", "delay_report", "documents", "explain_stages", "flat_tables", "global_delay",
    "insights", "load_stages", "method_counts", "nested_results", "po_delay_summary", "read_documents",
    "stage_delay", "stage_dim", "stage_matrix", "stage_wide", "stages_from_dict", "stages_long",
    "standard_stages", "team_delay", "timeline", "timeline_or_failures", "topological_order", "validate",
    "with_stage_dim", "worst_team",
]
