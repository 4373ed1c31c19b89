"""Group statuses: each row learns something about its whole batch or shipment.

All statuses of one group key are taken in a single grouping (partial results per task, one row
per group after the shuffle) and joined back; see ``join_unique`` for frequent groups. Rows
without a group keep their own value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .unique_join import join_unique


@dataclass(frozen=True)
class Rollup:
    """Aggregates to take per group, how a row reads them, and its value without a group."""

    parts: Mapping[str, Column]
    read: Callable[[Callable[[str], Column]], Column]
    own: Column


def _any(test: Column) -> Column:
    return F.bool_or(F.coalesce(test, F.lit(False)))


def any_of(column: str, value: str) -> Rollup:
    """``value`` if any row of the group has it, else the row's own."""
    own = F.col(column)
    return Rollup({"any": _any(own == value)}, lambda part: F.when(part("any"), F.lit(value)).otherwise(own), own)


def priority_of(column: str, ranked: Sequence[str], good: str, otherwise: str) -> Rollup:
    """The first of ``ranked`` present in the group; else ``otherwise`` if any row is not
    ``good``; else ``good``."""
    own = F.col(column)
    parts = {f"has_{at}": _any(own == value) for at, value in enumerate(ranked)}
    parts["not_good"] = F.bool_or(F.coalesce(own != good, F.lit(True)))

    def read(part):
        result = F.when(part("not_good"), F.lit(otherwise)).otherwise(F.lit(good))
        for at in range(len(ranked) - 1, -1, -1):
            result = F.when(part(f"has_{at}"), F.lit(ranked[at])).otherwise(result)
        return result

    return Rollup(parts, read, own)


def all_of(column: str, value: str, otherwise: str) -> Rollup:
    """``value`` only if every row of the group has it."""
    own = F.col(column)
    parts = {"all": F.bool_and(F.coalesce(own == value, F.lit(False)))}
    return Rollup(parts, lambda part: F.when(part("all"), F.lit(value)).otherwise(F.lit(otherwise)), own)


def max_date(column: str) -> Rollup:
    """The latest date of the group; missing for rows without a group."""
    own = F.col(column)
    return Rollup({"max": F.max(own)}, lambda part: part("max"), F.lit(None).cast("timestamp"))


def max_date_state(column: str, none: str = "No Batch", missing: str = "Not Scheduled", found: str = "Scheduled") -> Rollup:
    """Which case the latest date is: no group, no date in the group, or a date."""
    own = F.col(column)
    return Rollup(
        {"max": F.max(own)},
        lambda part: F.when(part("max").isNull(), F.lit(missing)).otherwise(F.lit(found)),
        F.lit(none),
    )


def roll_up(df: DataFrame, group: str, rules: Mapping[str, Rollup]) -> DataFrame:
    """Add one column per rule (output name -> rule) over the rows sharing ``group``."""
    return roll_up_all(df, {group: rules})


def roll_up_all(df: DataFrame, groups: Mapping[str, Mapping[str, Rollup]], row: str | None = None) -> DataFrame:
    """Add the columns of several group keys at once: key column -> rules (output name -> rule).

    All groups are taken in one grouping over rows of (which key, its value), so ``df`` is read twice however many keys
    there are: once with the columns that the rules read, and once to join the results back. The joins are on the pair as
    one value, so that each of them uses the same result of that grouping. Where ``df`` is a stored table whose rows the
    column ``row`` numbers, only number and key are moved per group, and the results go back by number.
    """
    stored = df
    named = [(group, out, rule) for group, rules in groups.items() for out, rule in rules.items()]
    parts = [column.alias(f"_{out}_{part}") for _, out, rule in named for part, column in rule.parts.items()]
    kinds = F.array(*[_group_key(group) for group in groups])
    keyed = df.withColumn("_group", F.explode(kinds)).where(F.col("_group.key").isNotNull())
    stats = keyed.groupBy("_group").agg(*parts)
    for group, rules in groups.items():
        columns = df.columns
        # A row without the key is in no group; it joins on a value of its own kind that no group has.
        if row is None or group not in stored.columns or group in set(df.columns) - set(stored.columns):
            df = join_unique(df.withColumn("_group", _group_key(group)), stats, ["_group"])
        else:
            keyed = stored.select(row, _group_key(group).alias("_group"))
            df = join_unique(df, join_unique(keyed, stats, ["_group"]), [row])
        outputs = {}
        for out, rule in rules.items():
            value = rule.read(lambda part, out=out: F.col(f"_{out}_{part}"))
            outputs[out] = F.when(F.col(f"`{group}`").isNull(), rule.own).otherwise(value)
        made = {name for _, out, rule in named for name in [f"_{out}_{part}" for part in rule.parts]} | {"_group"} | set(outputs)
        df = df.select(*[F.col(f"`{name}`") for name in columns if name not in made], *[c.alias(out) for out, c in outputs.items()])
    return df


def _group_key(group: str) -> Column:
    return F.struct(F.lit(group).alias("kind"), F.col(f"`{group}`").cast("string").alias("key"))
