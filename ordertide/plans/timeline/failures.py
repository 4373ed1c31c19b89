"""Rows that fail inside the timeline, set apart by stage while all others go on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import parse_any_date
from ...functions.values import present
from .config import Stage
from .engine import edges_of, stage_column, timeline
from .expressions import Scope, expression_error

#: An error in the predecessors leaves a stage without meaning, so the whole row is set apart. Errors in the other parts
#: count as a missing date there and are only reported.
FATAL = ("preceding",)
FAILURE = "array<struct<stage_id:string,part:string,error:string,fatal:boolean>>"


def readable_dates(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Text columns as timestamps, and for each a column that says where a text was there but was no date."""
    texts = {f"_text_{name}": F.col(f"`{name}`") for name in names}
    kept = df.withColumns(texts) if texts else df
    parsed = kept.withColumns({name: parse_any_date(F.col(f"`{name}`")) for name in names}) if names else kept
    wrong = {
        name: F.when(F.col(f"`{name}`").isNull() & present(F.col(f"`_text_{name}`"), ["NA"]).isNotNull(), F.lit(f"{name} is no date"))
        for name in names
    }
    return parsed, wrong


def _failures(stages: list[Stage], scope: Scope, fatal: Sequence[str]) -> tuple[Column, Column]:
    """All errors of a row, NULL where a part has none, and whether one of them is fatal."""
    found, ends = [], F.lit(False)
    for stage in stages:
        parts = {
            "preceding": edges_of(stage, scope).error, "actual": expression_error(stage.actual, scope),
            "fallback": expression_error(stage.fallback, scope),
        }
        found += [
            F.when(error.isNotNull(), F.struct(
                F.lit(stage.stage_id).alias("stage_id"), F.lit(part).alias("part"), error.alias("error"), F.lit(part in fatal).alias("fatal")))
            for part, error in parts.items() if error is not None
        ]
        for part, error in parts.items():
            if error is not None and part in fatal:
                ends = ends | error.isNotNull()
    return F.array(*found).cast(FAILURE), ends


def timeline_or_failures(
    df: DataFrame, stages: list[Stage], id_columns: Sequence[str], variant: str = "modular", keep: list[str] | None = None,
    text_dates: Sequence[str] = (), fatal: Sequence[str] = FATAL,
) -> tuple[DataFrame, DataFrame]:
    """The timeline of the rows without a fatal error, and all errors: (ids, stage_id, part, error, fatal).

    ``text_dates`` are columns that hold dates as text. Every row is in the timeline, or has a fatal error listed, never both.
    """
    rows, wrong = readable_dates(df, text_dates)
    made = timeline(rows, stages, variant)
    dates = {stage.stage_id: F.col(f"{stage_column(stage.stage_id)}.date") for stage in stages}
    failures, ends = _failures(stages, Scope(made.schema, dates, wrong), fatal)
    kept = df.columns if keep is None else keep
    good = made.where(~ends).select(
        *[F.col(f"`{name}`") for name in kept], *[stage_column(stage.stage_id) for stage in stages])
    # Tests on arrays are interpreted by Spark, with all that the array is made of; a test after the generator is not.
    listed = made.select(*id_columns, failures.alias("_failures")).select(*id_columns, F.inline_outer("_failures"))
    return good, listed.where("stage_id IS NOT NULL")
