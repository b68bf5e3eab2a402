"""Date parsing, formatting and calendar predicates.

Window predicates compare the bare column with literals, so they are pushed
into Parquet and JDBC scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col

Day = str | dt.date

# Layouts tried, in order, for files that declare none.
ISO_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
MONTH_FIRST_LAYOUTS = (
    *ISO_LAYOUTS,
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "MM-dd-yyyy HH:mm:ss",
    "MM-dd-yyyy",
    "dd-MMM-yyyy HH:mm:ss",
    "dd-MMM-yyyy",
)
DAY_FIRST_LAYOUTS = (
    *ISO_LAYOUTS,
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy",
    "dd-MMM-yyyy HH:mm:ss",
    "dd-MMM-yyyy",
)


def to_day(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def parse_date(c: ColumnOrName, layouts: Sequence[str] = ISO_LAYOUTS) -> Column:
    """Date from text by the first layout that fits; no fit gives null."""
    text = as_col(c).cast("string")
    return F.coalesce(*[F.try_to_date(text, layout) for layout in layouts])


def date_text(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(as_col(c), "yyyy-MM-dd")


def micros_text(c: ColumnOrName) -> Column:
    """Timestamp text with microseconds."""
    return F.date_format(as_col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def in_days(c: ColumnOrName, start: Day, end: Day) -> Column:
    """Both calendar days included."""
    return in_half_open(c, start, to_day(end) + dt.timedelta(days=1))


def in_half_open(c: ColumnOrName, start: Day, stop: Day) -> Column:
    """``start`` midnight included, ``stop`` midnight excluded."""
    col = as_col(c)
    return (col >= F.lit(to_day(start))) & (col < F.lit(to_day(stop)))


def in_lookahead(
    c: ColumnOrName, start: Day, end: Day, days: int = 30, closed: bool = True
) -> Column:
    """Window that also takes postings made up to ``days`` after ``end``.

    ``closed`` keeps an entry stamped exactly at the limit.
    """
    col, limit = as_col(c), F.lit(to_day(end) + dt.timedelta(days=days))
    return (col >= F.lit(to_day(start))) & (col <= limit if closed else col < limit)


def after_day(c: ColumnOrName, as_of: Day) -> Column:
    """Calendar day later than ``as_of``."""
    return as_col(c) >= F.lit(to_day(as_of) + dt.timedelta(days=1))


def _month_start(day: dt.date, shift: int = 0) -> dt.date:
    months = day.year * 12 + day.month - 1 + shift
    return dt.date(months // 12, months % 12 + 1, 1)


def in_month_of(c: ColumnOrName, as_of: Day) -> Column:
    """Same calendar month as ``as_of``."""
    day = to_day(as_of)
    return in_half_open(c, _month_start(day), _month_start(day, 1))


def in_month_before(c: ColumnOrName, as_of: Day) -> Column:
    """The whole calendar month before that of ``as_of``."""
    day = to_day(as_of)
    return in_half_open(c, _month_start(day, -1), _month_start(day))


# Fixed value: the year that marks an expiry date as never set.
UNSET_YEAR = 1971


def is_unset_year(c: ColumnOrName) -> Column:
    return F.year(as_col(c)) == UNSET_YEAR
