"""Filters and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import present

# Statuses that close a line, and the memo of lines tracked elsewhere.
CLOSED_STATUSES = ("Closed", "Legacy Closed", "Fully Billed")
EXCLUDED_MEMO = "import_ic_flow"


def open_lines(
    df: DataFrame, status: str = "final_status", ordered: str = "quantity",
    received: str = "quantity_received", memo: str | None = "memo",
    closed: Sequence[str] = CLOSED_STATUSES, excluded_memo: str = EXCLUDED_MEMO,
) -> DataFrame:
    """Lines with a known open status, something outstanding and no excluded memo."""
    kept = df.where(~F.col(status).isin(*closed) & ((F.col(ordered) - F.col(received)) > 0))
    if memo is None:
        return kept
    return kept.where(F.col(memo).isNull() | (F.col(memo) != excluded_memo))


def non_blank(df: DataFrame, key: str) -> DataFrame:
    return df.where(present(F.col(key).cast("string")).isNotNull())


def publish_view(
    df: DataFrame, columns: Mapping[str, str], dates: Sequence[str] = (), numbers: Sequence[str] = (),
    key: str | None = None,
) -> DataFrame:
    """Published columns (inside name -> shown name), listed dates and numbers coerced.

    With ``key``, rows whose key is blank are left out.
    """
    rows = non_blank(df, key) if key else df
    out = []
    for name, shown in columns.items():
        column = F.col(name)
        if name in dates:
            column = column.try_cast("timestamp")
        elif name in numbers:
            column = column.try_cast("double")
        out.append(column.alias(shown))
    return rows.select(*out)


def sample_first(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (a trial run on a few lines)."""
    return df.orderBy(*order).limit(n)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_constants(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in mapping.items()})
