"""Relational building blocks: latest rows, lookups, roll-ups, aggregates, projections."""

from .aggregates import cond_min, list_and_sum, max_by_key
from .incremental import LatestState
from .latest import (
    distinct_values, earliest, first_and_last, keep, keep_by_priority, latest,
)
from .lookups import (
    flag_exists, header_lines, inner_lookup, lookup, lookup_by_row, lookup_first, lookup_many, lookup_switch, lookup_when,
    map_values, restrict_to, shipment_star, sub_text, union_override,
)
from .projections import (
    non_blank, open_lines, publish_view, rename, sample_first, with_constants,
)
from .rollups import all_of, any_of, max_date_state, priority_of, roll_up, roll_up_all
from .row_tables import RowTables
from .unique_join import join_unique

__all__ = [
    "LatestState", "RowTables", "all_of", "any_of", "cond_min", "distinct_values", "earliest", "first_and_last",
    "flag_exists", "header_lines", "inner_lookup", "join_unique", "keep",
    "keep_by_priority", "latest", "list_and_sum", "lookup", "lookup_by_row", "lookup_first", "lookup_many", "lookup_switch",
    "lookup_when", "map_values", "max_by_key", "max_date_state", "non_blank", "open_lines",
    "priority_of", "publish_view", "rename", "restrict_to", "roll_up", "roll_up_all", "sample_first",
    "shipment_star", "sub_text", "union_override", "with_constants",
]
