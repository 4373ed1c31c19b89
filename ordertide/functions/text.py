"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before(c: Column | str, mark: str) -> Column:
    """Text before the first ``mark``; the whole text where it is absent."""
    return F.substring_index(_col(c), mark, 1)


def after(c: Column | str, mark: str) -> Column:
    """Text after the first ``mark``; NULL where it is absent."""
    c = _col(c)
    at = F.instr(c, mark)
    return F.when(at > 0, c.substr(at + F.lit(len(mark)), F.length(c)))


def after_n(c: Column | str, mark: str, n: int) -> Column:
    """The ``n`` characters after the first ``mark``; empty text where it is absent."""
    c = _col(c)
    at = F.instr(c, mark)
    return F.when(at > 0, c.substr(at + F.lit(len(mark)), F.lit(n))).otherwise(F.lit(""))


def last_n(c: Column | str, n: int) -> Column:
    return F.right(_col(c), F.lit(n))


def first_word(c: Column | str) -> Column:
    return before(c, " ")


def first_char(c: Column | str) -> Column:
    return F.substring(_col(c), 1, 1)


def prefix(c: Column | str, pattern: str) -> Column:
    """First group of ``pattern``; NULL where it does not match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def joined(*cols: Column | str) -> Column:
    """A visible composite id; NULL parts make the whole id NULL."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def pct_of(terms: Column | str, tag: str) -> Column:
    """The percentage named before ``tag`` in payment terms, e.g. ``30% PI``."""
    return prefix(terms, rf"(\d+)% {tag}").try_cast("double")


def bl_days(terms: Column | str, at_least: int = 45) -> Column:
    """Credit days after ``BL``; shorter credit than ``at_least`` counts as none."""
    days = prefix(terms, r"BL (\d+)").try_cast("int")
    return F.when(days >= at_least, days).otherwise(F.lit(0))


def parse_terms(terms: Column | str) -> dict[str, Column]:
    """Payment shares and credit days of terms like ``30% PI 0d 20% CI 0d 50% BL 60d``.

    The first share stays NULL when it cannot be read; the others become 0.
    """
    terms = _col(terms)

    def share(part: int) -> Column:
        text = F.split_part(F.split_part(terms, F.lit("%"), F.lit(part)), F.lit("d "), F.lit(2))
        return F.coalesce(F.nullif(text, F.lit("")).try_cast("int"), F.lit(0))

    tail = F.split_part(terms, F.lit("%"), F.lit(4))
    days = F.split_part(F.split_part(tail, F.lit(" "), F.lit(3)), F.lit("d"), F.lit(1))
    return {
        "pi_value": F.split_part(terms, F.lit("%"), F.lit(1)).try_cast("int"),
        "ci_value": share(2),
        "bl_value": share(3),
        "bl_days": F.coalesce(F.nullif(days, F.lit("")).try_cast("int"), F.lit(0)),
    }
