"""The stage timeline as a chain of projections.

A row needs nothing but itself, so the whole timeline is map-only: no shuffle, no grouping,
no Python in the tasks. Stages are taken in dependency order. Only the stage dates run through the
chain; what the predecessors reached, the method and the target follow from them at the end.

``FUSE`` levels share one projection. Within it a date is written into the expressions that read
it, and Spark evaluates the shared part once (subexpression elimination); between projections a
date is a column again, which keeps the expressions small. One projection per level would copy
every column of the row some thirty times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import plus_days
from .config import Stage, topological_order
from .expressions import (
    Edges, Scope, compile_edges, date_expression, latest_of, null_date, referenced_stages,
)

# How a stage date was found.
METHODS = (
    "actual_only", "precedence_only", "actual_over_precedence", "precedence_over_actual",
    "fallback", "failed",
)


@dataclass(frozen=True)
class Parts:
    """What a stage rule sees: predecessor date, actual date, fallback date, lead time."""

    reached: Column
    actual: Column | None
    fallback: Column | None
    lead: int


@dataclass(frozen=True)
class Rule:
    """A reading of the timeline rules: the stage date, how it was found, and its target."""

    date: Callable[[Parts], Column]
    method: Callable[[Parts], Column]
    target: Callable[[Parts], Column]


def _has(column: Column | None) -> Column:
    return F.lit(False) if column is None else column.isNotNull()


def _value(column: Column | None) -> Column:
    return null_date() if column is None else column


def _with_precedence(parts: Parts, late: Column, early: Column, alone: Column) -> Column:
    """The three outcomes for a stage whose predecessors have a date."""
    if parts.actual is None:
        return alone
    return (
        F.when(parts.actual >= parts.reached, late)
        .when(parts.actual.isNotNull(), early)
        .otherwise(alone)
    )


def _later_or(parts: Parts, otherwise: Column) -> Column:
    """The actual date where it is not before the predecessors; NULL without predecessors."""
    if parts.actual is None:
        return otherwise
    return F.when(parts.actual >= parts.reached, parts.actual).otherwise(otherwise)


def _current_date(parts: Parts) -> Column:
    done = _later_or(parts, plus_days(parts.reached, parts.lead))
    if parts.fallback is None or parts.actual is None:
        return done
    return F.coalesce(done, F.when(parts.fallback.isNotNull(), parts.actual))


def _current_method(parts: Parts) -> Column:
    return (
        F.when(parts.reached.isNotNull(), _precedence_method(parts))
        .when(~_has(parts.fallback), F.lit("failed"))
        .when(_has(parts.actual), F.lit("actual_only"))
        .otherwise(F.lit("fallback"))
    )


def _precedence_method(parts: Parts) -> Column:
    return _with_precedence(
        parts, F.lit("actual_over_precedence"), F.lit("precedence_over_actual"), F.lit("precedence_only"),
    )


def _current_target(parts: Parts) -> Column:
    return F.coalesce(plus_days(parts.reached, parts.lead), _value(parts.fallback))


def _legacy_date(parts: Parts) -> Column:
    if parts.actual is None:
        return plus_days(parts.reached, parts.lead)
    # The later of the two; the lead time counts only while there is no actual date.
    waiting = F.when(parts.actual.isNull(), plus_days(parts.reached, parts.lead))
    return F.coalesce(F.greatest(parts.actual, F.when(parts.actual.isNotNull(), parts.reached)), waiting)


def _legacy_method(parts: Parts) -> Column:
    return (
        F.when(parts.reached.isNotNull(), _precedence_method(parts))
        .when(_has(parts.actual), F.lit("actual_only"))
        .when(~_has(parts.fallback), F.lit("failed"))
    )


def _notebook_date(parts: Parts) -> Column:
    due = plus_days(parts.reached, parts.lead)
    if parts.actual is None:
        reached = due
    else:
        reached = F.greatest(due, parts.actual)
    return F.coalesce(reached, plus_days(_value(parts.fallback), parts.lead))


def _notebook_method(parts: Parts) -> Column:
    due = plus_days(parts.reached, parts.lead)
    shifted = Parts(due, parts.actual, parts.fallback, parts.lead)
    return (
        F.when(parts.reached.isNotNull(), _precedence_method(shifted))
        .when(_has(parts.actual), F.lit("actual_only"))
        .when(_has(parts.fallback), F.lit("fallback"))
        .otherwise(F.lit("failed"))
    )


def _notebook_target(parts: Parts) -> Column:
    return plus_days(F.coalesce(parts.reached, _value(parts.fallback)), parts.lead)


RULES = {
    "modular": Rule(_current_date, _current_method, _current_target),
    "legacy": Rule(_legacy_date, _legacy_method, _current_target),
    "notebook": Rule(_notebook_date, _notebook_method, _notebook_target),
}


FUSE = 4


def date_column(stage_id: str) -> str:
    return f"_date_{stage_id}"


def stage_column(stage_id: str) -> str:
    return f"stage_{stage_id}"


def stage_scope(df: DataFrame, stages: list[Stage]) -> Scope:
    return Scope(df.schema, {stage.stage_id: F.col(date_column(stage.stage_id)) for stage in stages})


def edges_of(stage: Stage, scope: Scope) -> Edges:
    return compile_edges(stage.preceding, scope, set(scope.stage_dates))


def _levels(stages: list[Stage]) -> list[list[Stage]]:
    """Stages grouped so that a level reads earlier levels only."""
    depth: dict[str, int] = {}
    levels: list[list[Stage]] = []
    for stage in topological_order(stages):
        needs = referenced_stages(stage.preceding, stage.fallback, stage.actual)
        at = max((depth[n] + 1 for n in needs if n in depth), default=0)
        depth[stage.stage_id] = at
        if at == len(levels):
            levels.append([])
        levels[at].append(stage)
    return levels


def _parts(stage: Stage, scope: Scope) -> Parts:
    return Parts(
        edges_of(stage, scope).choose(scope.latest),
        date_expression(stage.actual, scope),
        date_expression(stage.fallback, scope),
        stage.lead_time,
    )


def timeline(
    df: DataFrame, stages: list[Stage], variant: str = "modular", keep: list[str] | None = None,
    fuse: int = FUSE,
) -> DataFrame:
    """Add one struct column ``stage_<id>`` per stage.

    Fields: ``date``, ``method``, ``target_date``, ``precedence_date``, ``actual_date``.
    ``variant`` picks the rule reading (``modular``, ``legacy``, ``notebook``); ``keep`` lists
    the source columns to carry through (all by default).
    """
    rule = RULES[variant]
    scope = stage_scope(df, stages)
    kept = df.columns if keep is None else keep
    chain = df
    levels = _levels(stages)
    for start in range(0, len(levels), fuse):
        inner = Scope(df.schema, dict(scope.stage_dates))
        dates = {}
        for stage in (stage for level in levels[start:start + fuse] for stage in level):
            dates[stage.stage_id] = rule.date(_parts(stage, inner))
            inner.stage_dates[stage.stage_id] = dates[stage.stage_id]
        chain = chain.withColumns({date_column(stage_id): date for stage_id, date in dates.items()})
    return chain.select(
        *[F.col(f"`{name}`") for name in kept],
        *[_stage_struct(stage, rule, scope) for stage in stages],
    )


def _stage_struct(stage: Stage, rule: Rule, scope: Scope) -> Column:
    parts = _parts(stage, scope)
    return F.struct(
        F.col(date_column(stage.stage_id)).alias("date"),
        rule.method(parts).alias("method"),
        rule.target(parts).alias("target_date"),
        parts.reached.alias("precedence_date"),
        _value(parts.actual).alias("actual_date"),
    ).alias(stage_column(stage.stage_id))
