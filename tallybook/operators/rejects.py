"""Values that are present but cannot be read: which rows have them, and why.

A reconciliation keeps such rows in the bucket where they belong, with a null in place of the value.
The reject frame lists them beside the buckets, one row for each input row with every reason, so that
nobody takes a null for a missing amount. Lines that do not fit their file's layout have no values
at all: they are only in the reject frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col, quoted
from tallybook.functions.dates import parse_date
from tallybook.functions.numbers import is_unreadable
from tallybook.functions.text import drop_point_zero, is_present, strip, strip_currency
from tallybook.sources.files import MALFORMED


@dataclass(frozen=True)
class Check:
    """A column, by its header in any case, what it should hold, and the test for a value that it is not."""

    column: str
    kind: str
    bad: Callable[[str], Column]

    def reason(self, name: str) -> Column:
        return F.when(self.bad(name), F.lit(f"{self.column}: {self.kind}"))


def amount(column: str) -> Check:
    """An amount that ``to_decimal`` reads."""
    return Check(column, "amount", is_unreadable)


def currency(column: str) -> Check:
    """An amount that may have a currency symbol and spaces."""
    return Check(column, "amount", lambda name: is_unreadable(strip_currency(name)))


def serial(column: str) -> Check:
    """A whole number, with or without ``.0``."""

    def bad(name: str) -> Column:
        return is_present(name) & drop_point_zero(strip(name)).try_cast("bigint").isNull()

    return Check(column, "serial number", bad)


def date(column: str, layouts: Sequence[str]) -> Check:
    """A date in one of the layouts."""
    return Check(column, "date", lambda name: is_present(name) & parse_date(name, layouts).isNull())


def _named(df: DataFrame, checks: Sequence[Check]) -> list[tuple[Check, str]]:
    """The checks whose column the file has, with the column's own name."""
    names = {c.strip().upper(): c for c in df.columns}
    return [(c, names[c.column]) for c in checks if c.column in names]


def accepted(df: DataFrame) -> DataFrame:
    """The rows that fit the file's layout, without the mark of those that do not."""
    if MALFORMED not in df.columns:
        return df
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def rejected(df: DataFrame, side: str, checks: Sequence[Check]) -> DataFrame:
    """``(SIDE, REASON, RECORD)`` of every row of a raw file with a value that fails its check.

    ``REASON`` names each such column and what it should be, in the order of ``checks``, or is
    ``layout`` for a line that does not fit; ``RECORD`` is the row as JSON, or the line as it is.
    One pass without a shuffle; columns that no check names are only read for rejected rows' records.
    """
    reasons = F.array_compact(F.array(F.lit(None).cast("string"), *[c.reason(n) for c, n in _named(df, checks)]))
    fields = [quoted(c) for c in df.columns if c != MALFORMED]
    reason, record = F.array_join(reasons, ", "), F.to_json(F.struct(*fields))
    if MALFORMED in df.columns:
        line = F.col(MALFORMED)
        reason = F.when(line.isNotNull(), F.lit("layout")).otherwise(reason)
        record = F.coalesce(line, record)
    found = df.select(F.lit(side).alias("SIDE"), reason.alias("REASON"), record.alias("RECORD"))
    return found.where(as_col("REASON") != "")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(SIDE, REASON, n)``: rows by their reasons."""
    return rejects.groupBy("SIDE", "REASON").agg(F.count("*").alias("n"))
