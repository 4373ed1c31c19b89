"""Rows kept in several tables that are dealt out alike by row number.

The rows are stored once with their numbers. What lookups and roll-ups find for them is stored beside them, each find in a
table of its own in the same buckets, so whatever columns are read together, no row is moved for it. Each find is a step
of its own whose shuffle files go when it is done.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_staged, folder_bytes, staged, staged_by
from .lookups import lookup_by_row
from .unique_join import join_unique

#: Bytes of a stored table in one bucket; small tables have as many buckets as there are cores, if that leaves each so much.
BUCKET_BYTES, LEAST_BYTES = 16 << 20, 512 << 10


class RowTables:
    """A table of rows numbered by ``row``, and what was found for them."""

    def __init__(self, df: DataFrame, folder: str, row: str = "_row", derived: Mapping[str, Column] | None = None):
        """Store ``df`` in ``folder``; ``derived`` columns follow from a row alone and are made when they are read."""
        self.row, self.folder = row, folder.rstrip("/")
        spark, aside = df.sparkSession, f"{self.folder}/staged-rows-{uuid.uuid4().hex}"
        numbered = staged(df.withColumn(row, F.monotonically_increasing_id()), aside)
        size, cores = folder_bytes(spark, aside), spark.sparkContext.defaultParallelism
        self.parts = max(1, -(-size // BUCKET_BYTES), min(cores, -(-size // LEAST_BYTES)))
        stored = staged_by(numbered, self.folder, row, self.parts)
        drop_staged(spark, aside)
        self.tables = [stored.withColumns(dict(derived or {}))]

    def add(self, found: DataFrame, dealt: bool = False) -> None:
        """Store columns found for all rows; they count instead of columns of their names found before."""
        self.tables.append(staged_by(found, self.folder, self.row, self.parts, dealt))

    def read(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The row numbers with these columns, or with all."""
        holder = {name: at for at, table in enumerate(self.tables) for name in table.columns if name != self.row}
        wanted = list(holder) if columns is None else [name for name in dict.fromkeys(columns) if name != self.row]
        held = {at: [name for name in wanted if holder[name] == at] for at in {holder[name] for name in wanted} or {0}}
        df = None
        # All have the same rows. The widest comes last, as each join copies what was read before it.
        for at in sorted(held, key=lambda at: (len(held[at]), at)):
            part = self.tables[at].select(self.row, *[F.col(f"`{name}`") for name in held[at]])
            df = part if df is None else join_unique(df, part, [self.row])
        return df.select(self.row, *[F.col(f"`{name}`") for name in wanted])

    def look_up(
        self, groups: Sequence[tuple[Sequence[str], Sequence[DataFrame]]], defaults: Mapping[str, object] | None = None,
    ) -> None:
        """``lookup_by_row`` on several keys; only numbers and keys meet the sides."""
        groups = [(keys, sides) for keys, sides in groups if sides]
        found = list(dict.fromkeys(name for keys, sides in groups for side in sides for name in side.columns if name not in keys))
        if not found:
            return
        made, keys_read = set(), []
        for keys, sides in groups:
            keys_read += [key for key in keys if key not in made]
            made |= {name for side in sides for name in side.columns if name not in keys}
        df = lookup_by_row(self.read(keys_read), self.row, groups, defaults)
        self.add(df.select(self.row, *[F.col(f"`{name}`") for name in found]), dealt=True)


def stored_star(shipments: DataFrame, sides: Mapping[str, tuple[str | Sequence[str], DataFrame]], staging: str) -> DataFrame:
    """``shipment_star`` with the shipments stored in ``staging``: each side is a step that moves numbers and keys only."""
    rows = RowTables(shipments, staging)
    for key, side in sides.values():
        rows.look_up([([key] if isinstance(key, str) else list(key), [side])])
    return rows.read().drop(rows.row)
