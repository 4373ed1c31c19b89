"""Missing values, numbers and small value rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market codes that report under one name.
LATAM_MARKETS = ("CO", "MX", "BR")
PAN_EU_MARKETS = ("FR", "BE", "ES", "PL", "NL", "SE", "IT", "DE")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str, also_missing: Iterable[str] = ()) -> Column:
    """The trimmed text, or NULL where it is blank or one of ``also_missing``."""
    text = F.trim(_col(c))
    missing = ["", *also_missing]
    return F.when(~text.isin(missing), text)


def blank_to(c: Column | str, text: str, also_missing: Iterable[str] = ()) -> Column:
    """``text`` where the value is missing or blank."""
    return F.coalesce(present(c, also_missing), F.lit(text))


def first_present(*cols: Column | str) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def to_number(c: Column | str, kind: str = "double", default=None) -> Column:
    """A number, or ``default`` where the text is not one."""
    value = _col(c).try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def is_value(c: Column | str, *values: str) -> Column:
    """True only for a present value in ``values``; missing counts as False."""
    return F.coalesce(_col(c).isin(*values), F.lit(False))


def latam_group(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isin(*LATAM_MARKETS), F.lit("LATAM")).otherwise(c)


def pan_eu_group(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isin(*PAN_EU_MARKETS), F.lit("Pan-EU")).otherwise(c)


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))
