"""Registered queries against their SQL. The slower plans are covered by a few that contain the rest;
``python -m checks.compare <dir>`` runs them all."""

import pytest

from checks.compare import compare, connect
from checks.operator_queries import QUERIES as OPERATORS
from checks.registry import ORACLE, QUERIES

REPORTS = (
    "open_lines", "payment_types", "status_report", "stage_flags", "blocker_owner", "group_payments",
    "timeline_small", "timeline_legacy", "timeline_notebook", "timeline_full", "stage_delay",
    "stage_delay_integrated", "stage_wide", "stage_dependencies", "stage_metadata", "insights",
    "po_delay_summary", "null_profile", "parse_dates",
)


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [*OPERATORS, *REPORTS])
def test_query_matches_sql(spark, sf, db, name):
    state, detail = compare(spark, db, sf, QUERIES[name], ORACLE[name])
    assert state == "ok", detail


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
