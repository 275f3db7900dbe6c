"""Column functions for cleaning scraped text (all JVM-side, codegen-friendly).

Each takes and returns a :class:`~pyspark.sql.Column`, so they compose into a
single projection that Catalyst collapses with its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(c: ColumnOrName, delimiter: str, n: int) -> Column:
    """``SPLIT_PART``: literal delimiter, 1-based; past the end gives ``''``; null stays null."""
    return F.split_part(_c(c), F.lit(delimiter), F.lit(n))


def trimmed_part(c: ColumnOrName, delimiter: str, n: int) -> Column:
    """``TRIM(SPLIT_PART(c, delimiter, n))``."""
    return F.trim(part(c, delimiter, n))


def split_pair(c: ColumnOrName, delimiter: str) -> tuple[Column, Column]:
    """Both trimmed halves of ``a <delimiter> b`` (bid/ask ``price x size``, ranges ``low - high``)."""
    return trimmed_part(c, delimiter, 1), trimmed_part(c, delimiter, 2)


def parse_mon_date(c: ColumnOrName, fmt: str = "MMM d, yyyy") -> Column:
    """``TO_DATE(s, 'Mon DD, YYYY')``; ``''`` and unparsable text give null instead of an error.

    ``''`` (a range with one date) is answered without calling the parser:
    a failed parse is far slower than the comparison.
    """
    s = _c(c)
    return F.when(s != F.lit(""), F.try_to_date(s, fmt))


def date_range(c: ColumnOrName, delimiter: str = "-") -> tuple[Column, Column]:
    """Earliest and latest date of ``'Jul 31, 2025 - Aug 4, 2025'``; a single date has no max."""
    lo, hi = split_pair(c, delimiter)
    return (F.when(lo.isNotNull(), parse_mon_date(lo)),
            F.when(hi.isNotNull(), parse_mon_date(hi)))


def drop_last_char(c: ColumnOrName) -> Column:
    """``LEFT(s, LENGTH(s) - 1)``: drop a one-letter unit suffix; ``''`` stays ``''``."""
    s = _c(c)
    return F.left(s, F.length(s) - F.lit(1))


def digits_only(c: ColumnOrName) -> Column:
    """``REGEXP_REPLACE(s, '[^0-9]', '')`` over every match."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def strip_literal(c: ColumnOrName, text: str) -> Column:
    """``REPLACE(s, text, '')``: remove a heading the page puts before a value."""
    return F.replace(_c(c), F.lit(text), F.lit(""))


def address_parts(c: ColumnOrName) -> dict[str, Column]:
    """Split ``street, city state zip country`` into five parts.

    The second comma part is split on single spaces, so a two-word city shifts
    the later parts; a missing comma leaves city and state ``''`` and the zip
    and country ``''`` as well.
    """
    second = trimmed_part(c, ",", 2)
    return {
        "street": trimmed_part(c, ",", 1),
        "city": part(second, " ", 1),
        "state": part(second, " ", 2),
        "zip": F.coalesce(part(second, " ", 3), F.lit("")),
        "country": F.coalesce(part(second, " ", 4), F.lit("")),
    }
