"""Delay of each stage against its target date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import as_timestamp, days_between
from .config import Stage
from .engine import stage_column

# Delay statuses.
DELAY_STATUSES = ("delayed", "early", "on_time", "pending", "pending_overdue", "unknown")


def delay_column(stage_id: str) -> str:
    return f"delay_{stage_id}"


def stage_delay(df: DataFrame, stages: list[Stage], as_of, mode: str = "report") -> DataFrame:
    """Add a struct column ``delay_<id>`` per stage to a timeline.

    Fields: ``days`` (whole days rounded down, positive when late), ``status``, ``reason``,
    ``team``, ``target``. An open stage counts as overdue once ``as_of`` has passed its target.
    Stages that never have an actual date stay ``unknown`` in mode ``integrated`` and are
    pending or overdue in mode ``report``.

    Target, actual date, days and status are columns of their own first, as each is read several times by
    what follows and a struct field would be worked out again at every reading, or the whole struct
    passed on through every step.
    """
    if mode not in ("report", "integrated"):
        raise ValueError("mode is 'report' or 'integrated'")
    now = as_timestamp(as_of)
    measured = {stage.stage_id for stage in stages if stage.actual is not None or mode == "report"}
    unmeasured = {"days": F.lit(None).cast("long"), "status": F.lit("unknown")}
    steps = (
        ("target", lambda stage: F.coalesce(_stage(stage, "target_date"), _stage(stage, "date"))),
        ("days", lambda stage: _days(stage, now)),
        ("status", _status),
    )
    names = df.columns
    for step, build in steps:
        columns = {
            _step(stage, step): build(stage) if step == "target" or stage.stage_id in measured else unmeasured[step]
            for stage in stages
        }
        if step == "target":
            columns |= {_step(stage, "actual"): _stage(stage, "actual_date") for stage in stages}
        df = df.withColumns(columns)
    return df.select(*[F.col(f"`{name}`") for name in names], *[_delay(stage) for stage in stages])


def _stage(stage: Stage, field: str) -> Column:
    return F.col(f"{stage_column(stage.stage_id)}.{field}")


def _step(stage: Stage, step: str) -> str:
    return f"_{step}_{stage.stage_id}"


def _days(stage: Stage, now: Column) -> Column:
    target = F.col(_step(stage, "target"))
    reached = F.coalesce(F.col(_step(stage, "actual")), F.when(now > target, now))
    return days_between(reached, target)


def _status(stage: Stage) -> Column:
    days = F.col(_step(stage, "days"))
    return (
        F.when(F.col(_step(stage, "target")).isNull(), "unknown")
        .when(F.col(_step(stage, "actual")).isNull(), F.when(days.isNotNull(), "pending_overdue").otherwise("pending"))
        .when(days > 0, "delayed").when(days < 0, "early").otherwise("on_time")
    )


def _delay(stage: Stage) -> Column:
    days, status = F.col(_step(stage, "days")), F.col(_step(stage, "status"))
    text = days.cast("string")
    reason = (
        F.when(status == "delayed", F.concat(F.lit("Actual completion "), text, F.lit(" days after target")))
        .when(status == "early", F.concat(F.lit("Completed "), F.abs(days).cast("string"), F.lit(" days before target")))
        .when(status == "on_time", F.lit("Completed on target date"))
        .when(status == "pending_overdue", F.concat(F.lit("Stage incomplete, "), text, F.lit(" days overdue")))
        .when(status == "pending", F.lit("Stage not yet completed"))
    )
    return F.struct(
        days.alias("days"), status.alias("status"), reason.alias("reason"),
        F.when(days.isNotNull(), F.lit(stage.flow.team_owner)).alias("team"),
        F.col(_step(stage, "target")).alias("target"),
    ).alias(delay_column(stage.stage_id))
