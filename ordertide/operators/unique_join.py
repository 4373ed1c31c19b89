"""A left join to a side with one row per key.

Both inputs are read once, so any number of such joins may follow each other. Spark broadcasts a side that is small by
its own measure; otherwise both are shuffled by key, and joins on one key in a row shuffle the rows once. Rows of a
frequent key, or without a key, pile up in one partition of the left side; ``forceOptimizeSkewedJoin`` in the session
defaults lets Spark split that partition while the query runs, unless the side was grouped or ranked by that key just before,
for then it is not shuffled for the join. Where many rows have no key, name columns in ``spread``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(df: DataFrame, side: DataFrame, keys: Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Left join ``df`` to ``side``, which has at most one row per ``keys``.

    Rows without a key have no match; with ``spread`` they are dealt out by those columns of ``df`` and not to one task.
    """
    if not spread:
        return df.join(side, list(keys), "left")
    missing = F.greatest(*[F.col(f"`{key}`").isNull() for key in keys], F.lit(False))
    named = [F.col(f"`{key}`") for key in keys]
    dealt = F.when(missing, F.xxhash64(*[F.col(f"`{name}`") for name in spread]))
    left = df.withColumn("_on", F.struct(*named, dealt.alias("_dealt")))
    rest = [name for name in side.columns if name not in keys]
    right = side.select(F.struct(*named, F.lit(None).cast("long").alias("_dealt")).alias("_on"), *[F.col(f"`{name}`") for name in rest])
    first = [*keys, *[name for name in df.columns if name not in keys]]
    return left.join(right, "_on", "left").select(*[left[f"`{name}`"] for name in first], *[right[f"`{name}`"] for name in rest])
