"""Stage configuration: what each stage depends on, falls back to, takes and who owns it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...sources.readers import small_table
from .expressions import referenced_stages


@dataclass(frozen=True)
class ProcessFlow:
    critical_path: bool = False
    process_type: str = ""
    team_owner: str = ""
    parallel_processes: tuple[str, ...] = ()
    handoff_points: tuple[str, ...] = ()


@dataclass(frozen=True)
class Stage:
    """One stage. ``preceding`` and ``fallback`` are expressions over columns and stages."""

    stage_id: str
    name: str
    actual: str | None = None
    preceding: str | tuple[str, ...] | None = None
    fallback: str | None = None
    lead_time: int = 0
    flow: ProcessFlow = field(default_factory=ProcessFlow)


def stages_from_dict(data: dict) -> list[Stage]:
    """Stages from the parsed JSON form, in file order."""
    stages = []
    for stage_id, body in data["stages"].items():
        flow = body.get("process_flow", {})
        preceding = body.get("preceding_stage")
        if isinstance(preceding, list):
            preceding = tuple(str(item) for item in preceding)
        stages.append(Stage(
            stage_id=str(stage_id),
            name=body["name"],
            actual=body.get("actual_timestamp") or None,
            preceding=preceding or None,
            fallback=body.get("fallback_calculation", {}).get("expression") or None,
            lead_time=body["lead_time"],
            flow=ProcessFlow(
                critical_path=bool(flow.get("critical_path", False)),
                process_type=flow.get("process_type", ""),
                team_owner=flow.get("team_owner", ""),
                parallel_processes=tuple(flow.get("parallel_processes") or ()),
                handoff_points=tuple(flow.get("handoff_points") or ()),
            ),
        ))
    validate(stages)
    return stages


def load_stages(path: str) -> list[Stage]:
    """Read and check a stage configuration file (a small driver-side JSON document)."""
    with open(path, encoding="utf-8-sig") as handle:
        return stages_from_dict(json.load(handle))


def topological_order(stages: list[Stage]) -> list[Stage]:
    """Stages ordered so that each one follows every stage any row may read for it.

    Both sources count: predecessor lists and ``stage_N`` names inside expressions.
    """
    by_id = {stage.stage_id: stage for stage in stages}
    position = {stage.stage_id: at for at, stage in enumerate(stages)}
    sorter = TopologicalSorter()
    for stage in stages:
        needs = referenced_stages(stage.preceding, stage.fallback, stage.actual)
        sorter.add(stage.stage_id, *sorted((n for n in needs if n in by_id), key=position.get))
    try:
        return [by_id[stage_id] for stage_id in sorter.static_order()]
    except CycleError as error:
        raise ValueError(f"stages depend on each other in a circle: {error.args[1]}") from error


def validate(stages: list[Stage]) -> list[Stage]:
    """Check ids, lead times and dependencies; returns the evaluation order."""
    seen = set()
    for stage in stages:
        if not stage.stage_id.strip():
            raise ValueError("a stage id is empty")
        if stage.stage_id in seen:
            raise ValueError(f"stage id {stage.stage_id} is used twice")
        seen.add(stage.stage_id)
        if isinstance(stage.lead_time, bool) or not isinstance(stage.lead_time, int) or stage.lead_time < 0:
            raise ValueError(f"stage {stage.stage_id}: lead time must be a whole number of days >= 0")
    return topological_order(stages)


def stage_dim(spark: SparkSession, stages: list[Stage]) -> DataFrame:
    """The configuration as a small table, one row per stage."""
    rows = [
        (
            at, stage.stage_id, stage.name, stage.flow.team_owner, stage.flow.process_type,
            stage.flow.critical_path, stage.lead_time,
            ",".join(stage.flow.parallel_processes), ",".join(stage.flow.handoff_points),
        )
        for at, stage in enumerate(stages)
    ]
    dim = small_table(
        spark, rows,
        "position int, stage_id string, stage_name string, team_owner string, process_type string,"
        " critical_path boolean, lead_time int, parallel_processes string, handoff_points string",
    )
    return dim.withColumns({
        name: F.filter(F.split(name, ","), lambda item: item != "")
        for name in ("parallel_processes", "handoff_points")
    })
