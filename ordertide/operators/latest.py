"""Latest-state and de-duplication operators.

``row_number() = 1`` lets Spark drop all but one row per key inside each map task before the
shuffle (window group limit), so a key with very many rows sends one row per task. Where ties are
kept that no longer bounds the group; there the latest moment per key is aggregated first and
joined back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .unique_join import join_unique


def _columns(order: Iterable[str | Column]) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in order]


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Exactly one row per key: the first in ``order``."""
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def latest(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], ties: bool = False,
) -> DataFrame:
    """The row with the greatest ``order`` per key; with ``ties`` every row sharing it."""
    if not ties:
        return first_by(df, keys, [column.desc_nulls_last() for column in _columns(order)])
    # Key and moment are structs: rows with a missing key form a group of their own, and missing
    # moments sort below present ones.
    marked = df.withColumns({"_key": F.struct(*_columns(keys)), "_moment": F.struct(*_columns(order))})
    tops = marked.groupBy("_key").agg(F.max("_moment").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    joined = join_unique(marked, tops, ["_key"])
    return joined.where(F.col("_moment") == F.col("_top")).select(*df.columns)


def earliest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The row with the least ``order`` per key."""
    return first_by(df, keys, [column.asc_nulls_last() for column in _columns(order)])


def first_and_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
) -> DataFrame:
    """First and last attempt per key in one grouping: ``first_<v>``, ``last_<v>``, attempts."""
    row = F.struct(*order, *[name for name in values if name not in order])
    # Missing moments are neither first nor last while there are others.
    first = F.struct(*[part.alias(f"o{at}") for at, name in enumerate(order) for part in (F.col(name).isNull(), F.col(name))], row.alias("row"))
    grouped = df.groupBy(*keys).agg(
        F.min(first).alias("_early"), F.max(row).alias("_last"), F.count(F.lit(1)).alias("attempts")
    ).withColumn("_first", F.col("_early.row"))
    return grouped.select(
        *keys, "attempts",
        *[F.col(f"_first.{name}").alias(f"first_{name}") for name in values],
        *[F.col(f"_last.{name}").alias(f"last_{name}") for name in values],
    )


def keep(df: DataFrame, keys: Sequence[str], which: str, seq: str | Sequence[str]) -> DataFrame:
    """Keep the first or last row per key in load order, given by ``seq``."""
    order = [seq] if isinstance(seq, str) else list(seq)
    if which == "first":
        return earliest(df, keys, order)
    if which == "last":
        return latest(df, keys, order)
    raise ValueError("which is 'first' or 'last'")


def keep_by_priority(
    df: DataFrame, keys: Sequence[str], column: str, priorities: Sequence[str],
    prefer: str = "best", tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key by the rank of ``column`` in ``priorities`` (compared trimmed, lower case).

    Values outside the list rank last. ``prefer='worst'`` keeps the other end.
    """
    text = F.lower(F.trim(F.col(column)))
    rank = F.lit(len(priorities) + 1)
    for at in range(len(priorities), 0, -1):
        rank = F.when(text == priorities[at - 1].lower(), F.lit(at)).otherwise(rank)
    first = rank.asc() if prefer == "best" else rank.desc()
    return first_by(df, keys, [first, *[c.asc_nulls_last() for c in _columns(tiebreak)]])


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
