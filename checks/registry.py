"""All queries and their SQL."""

from __future__ import annotations

from functools import wraps

from ordertide.session import tune

from . import (
    file_queries, intake_oracle, intake_queries, operator_oracle, operator_queries, status_oracle, status_queries, timeline_oracle, timeline_queries,
)

_MODULES = (
    (operator_queries.QUERIES, operator_oracle.ORACLE),
    (status_queries.QUERIES, status_oracle.ORACLE),
    (timeline_queries.QUERIES, timeline_oracle.ORACLE),
    (intake_queries.QUERIES, intake_oracle.ORACLE),
    (file_queries.QUERIES, file_queries.ORACLE),
)


def _tuned(query):
    """Run in a session of its own, so that the caller's settings stay as they are."""
    @wraps(query)
    def run(spark, sf_dir):
        own = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if own.conf.isModifiable(key):
                own.conf.set(key, value)
        return query(tune(own), sf_dir)
    return run


QUERIES = {name: _tuned(query) for queries, _ in _MODULES for name, query in queries.items()}
ORACLE = {name: sql for _, oracle in _MODULES for name, sql in oracle.items()}
