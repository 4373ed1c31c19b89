"""Lookups: left joins to reference tables with one row per key, defaults and switches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import first_by
from .unique_join import join_unique

# Payment statuses from best to worst.
PAYMENT_PRIORITY = ("paid in full", "pending approval", "open")


def _key_pairs(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    """Left key -> right key."""
    if isinstance(on, str):
        return {on: on}
    if isinstance(on, Mapping):
        return dict(on)
    return {name: name for name in on}


def checked_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` unchanged; the job fails if a key occurs twice. Rows without a key are not looked up and left out."""
    present = dim.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    twice = F.raise_error(F.concat(F.lit(f"repeated {', '.join(keys)}: "), F.concat_ws(", ", *keys))).cast("boolean")
    numbered = present.withColumn("_number", number)
    return numbered.where(F.when(F.col("_number") > 1, twice).otherwise(F.lit(True))).drop("_number")


def one_per_key(dim: DataFrame, keys: Sequence[str], pick: str, seq: Sequence[str]) -> DataFrame:
    """De-duplicate by load order; ``pick='unique'`` trusts the source and changes nothing, ``'checked'`` checks it."""
    if pick == "unique":
        return dim
    if pick == "checked":
        return checked_unique(dim, keys)
    if not seq:
        raise ValueError("picking the first or last row needs a load order (seq)")
    columns = [F.col(name) for name in seq]
    order = [c.asc_nulls_last() if pick == "first" else c.desc_nulls_last() for c in columns]
    return first_by(dim, list(keys), order)


def lookup(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str] | Mapping[str, str],
    values: Mapping[str, str], default: Mapping[str, object] | None = None,
    pick: str = "unique", seq: Sequence[str] = (),
) -> DataFrame:
    """Add columns looked up in ``dim``: output name -> column of ``dim``.

    Rows without a match, or with a missing value, get the default of that output (a value or a
    Column); without a default they stay missing. Several outputs share one join.
    """
    pairs = _key_pairs(on)
    side = one_per_key(dim, list(pairs.values()), pick, seq).select(
        *[F.col(f"`{right}`").alias(left) for left, right in pairs.items()],
        *[F.col(f"`{source}`").alias(f"_found_{out}") for out, source in values.items()],
    )
    joined = join_unique(df, side, list(pairs))
    defaults = default or {}
    outputs = {}
    for out in values:
        found = F.col(f"`_found_{out}`")
        if out in defaults:
            other = defaults[out]
            found = F.coalesce(found, other if isinstance(other, Column) else F.lit(other))
        outputs[out] = found
    carried = [name for name in df.columns if name not in outputs]
    return joined.select(
        *[F.col(f"`{name}`") for name in carried],
        *[column.alias(out) for out, column in outputs.items()],
    )


def lookup_many(
    df: DataFrame, keys: Sequence[str], sides: Sequence[DataFrame], defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Columns of several one-row-per-key sides on the same key.

    The joins follow each other on one key, so Spark moves the rows of ``df`` once for all of them.
    """
    for side in sides:
        names = [name for name in side.columns if name not in keys]
        given = {name: (defaults or {})[name] for name in names if name in (defaults or {})}
        df = lookup(df, side, list(keys), {name: name for name in names}, given)
    return df


def lookup_by_row(
    df: DataFrame, row: str, groups: Sequence[tuple[Sequence[str], Sequence[DataFrame]]],
    defaults: Mapping[str, object] | None = None, base: DataFrame | None = None,
) -> DataFrame:
    """``lookup_many`` on several keys after each other, moving the rows of ``df`` once and not once per key.

    ``row`` numbers the rows of a stored table, which is ``df`` or the ``base`` it was made from. Per key only number and
    key meet the sides, and what they find goes back by number. A key that an earlier side has set is read after it. Rows
    without a key have no match and are not moved for it.
    """
    base, found_before = df if base is None else base, set()
    for keys, sides in groups:
        names = list(dict.fromkeys(name for side in sides for name in side.columns if name not in keys))
        if not sides:
            continue
        source = df if found_before & set(keys) else base
        keyed = source.select(row, *[F.col(f"`{key}`") for key in keys]).where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
        found = lookup_many(keyed, keys, sides).drop(*keys)
        carried = [name for name in df.columns if name not in names]
        joined = join_unique(df.select(*[F.col(f"`{name}`") for name in carried]), found, [row])
        outputs = []
        for name in names:
            column, other = F.col(f"`{name}`"), (defaults or {}).get(name)
            if other is not None:
                column = F.coalesce(column, other if isinstance(other, Column) else F.lit(other))
            outputs.append(column.alias(name))
        df = joined.select(*[F.col(f"`{name}`") for name in carried], *outputs)
        found_before |= set(names)
    return df


def lookup_first(
    df: DataFrame, dim: DataFrame, on, value: tuple[str, str], default, seq: Sequence[str],
) -> DataFrame:
    """The first matching row's value, else the default."""
    out, source = value
    return lookup(df, dim, on, {out: source}, {out: default}, "first", seq)


def flag_exists(df: DataFrame, dim: DataFrame, on, name: str, yes: str = "Yes", no: str = "No") -> DataFrame:
    """Whether the key occurs in ``dim``, as one of two texts."""
    pairs = _key_pairs(on)
    known = dim.select(*[F.col(f"`{right}`").alias(left) for left, right in pairs.items()])
    known = known.distinct().withColumn("_known", F.lit(True))
    joined = join_unique(df, known, list(pairs))
    flag = F.when(F.col("_known"), F.lit(yes)).otherwise(F.lit(no))
    return joined.select(*[F.col(f"`{column}`") for column in df.columns], flag.alias(name))


def header_lines(headers: DataFrame, lines: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Lines with the columns of their header."""
    return lines.join(headers, on, "inner")


def inner_lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], where: Column) -> DataFrame:
    """Rows joined to the ``dim`` rows that pass ``where``; the test runs before the join."""
    return df.join(dim.where(where), on, "inner")


def restrict_to(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows whose key occurs in ``other``; a row never multiplies."""
    pairs = _key_pairs(on)
    known = other.select(*[F.col(f"`{right}`").alias(left) for left, right in pairs.items()])
    return df.join(known, list(pairs), "left_semi").select(*[F.col(f"`{name}`") for name in df.columns])


def shipment_star(
    shipments: DataFrame, sides: Mapping[str, tuple[str | Sequence[str], DataFrame]], spread: Sequence[str] = (),
) -> DataFrame:
    """Left joins to sides already reduced to one row per key: name -> (key, side).

    A key that an earlier side brings is missing wherever that side has none; such rows are dealt out by ``spread``.
    """
    star = shipments
    for key, side in sides.values():
        keys = [key] if isinstance(key, str) else list(key)
        star = join_unique(star, side, keys, [] if set(keys) <= set(shipments.columns) else spread)
    return star


def union_override(
    sources: Sequence[DataFrame], keys: Sequence[str], seq: Sequence[str] = (), pick: str = "last",
) -> DataFrame:
    """All rows of several lookups, one per key: a later source wins over an earlier one.

    Within a source ``seq`` orders the rows and ``pick`` says which end is kept.
    """
    merged = None
    for at, source in enumerate(sources):
        tagged = source.withColumn("_source", F.lit(at))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    inner = [F.col(name).desc_nulls_last() if pick == "last" else F.col(name).asc_nulls_last() for name in seq]
    return first_by(merged, list(keys), [F.col("_source").desc(), *inner]).drop("_source")


def sub_text(
    df: DataFrame, status_dim: DataFrame, code: str, out: str = "sub_status", text: str = "sub_status",
) -> DataFrame:
    """The text of a sub-stage code, looked up by the code itself."""
    return lookup(df, status_dim, {code: "code"}, {out: text})


def lookup_switch(
    df: DataFrame, use_first: Column, first: tuple[DataFrame, str, object],
    second: tuple[DataFrame, str, object], on: str, out: str, pick: str = "unique",
    seq: Sequence[str] = (),
) -> DataFrame:
    """A value from one of two sources, chosen per row: (source, value column, default) each.

    Each row carries only the key of the source it uses, so it is joined to that one alone.
    """
    keyed = df.withColumns({
        "_on_first": F.when(use_first, F.col(on)),
        "_on_second": F.when(~F.coalesce(use_first, F.lit(False)), F.col(on)),
    })
    for name, (source, value, default) in (("_on_first", first), ("_on_second", second)):
        keyed = lookup(keyed, source, {name: on}, {f"{name}_value": value}, {f"{name}_value": default},
                       pick, seq)
    chosen = F.when(use_first, F.col("_on_first_value")).otherwise(F.col("_on_second_value"))
    return keyed.withColumn(out, chosen).select(*[c for c in df.columns if c != out], out)


def map_values(column: Column | str, mapping: Mapping[str, object], default=None) -> Column:
    """A short literal value map as a CASE; ``default`` may be a Column."""
    column = F.col(column) if isinstance(column, str) else column
    other = default if isinstance(default, Column) else F.lit(default)
    result = None
    for value, target in mapping.items():
        branch = (column == value, F.lit(target))
        result = F.when(*branch) if result is None else result.when(*branch)
    return other if result is None else result.otherwise(other)


def lookup_when(
    df: DataFrame, condition: Column, dim: DataFrame, on, value: tuple[str, str], default,
    pick: str = "unique", seq: Sequence[str] = (),
) -> DataFrame:
    """Look up only where ``condition`` holds; every other row gets the default."""
    out, source = value
    found = lookup(df, dim, on, {"_looked_up": source}, {"_looked_up": default}, pick, seq)
    other = default if isinstance(default, Column) else F.lit(default)
    return found.withColumn(out, F.when(condition, F.col("_looked_up")).otherwise(other)).drop("_looked_up")
