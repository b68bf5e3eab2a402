"""Row filters whose treatment of nulls matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col
from tallybook.functions.dates import Day, in_days, is_unset_year
from tallybook.functions.text import matches, null_words_to_null, strip

# Ledger texts that are no customer transactions, texts of failed
# transactions, refund entries, and the reference prefix of bill payments.
NON_TRANSACTION = (
    r"(?i)settlement|Merchant Two Factor Authentication Charges|Ministatement"
)
FAILURE_OR_NA = r"failure|transaction timed out|^na$"
FAILURE = r"(?i)failure|transaction timed out"
REFUND_ENTRY = r"^(BBPS-)?[A-Z]{2,3}\d{1,2}-REF-"
BILL_PREFIX = "KM"
# Fixed value: the only status text that marks a refunded application.
REFUNDED_APPLICATION = "Payment Refunded due to Incomplete Application"


def drop_all_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which every listed column is null go; no-op unless all the columns exist."""
    if not set(names) <= set(df.columns):
        return df
    return df.where(F.coalesce(*[as_col(n) for n in names]).isNotNull())


def exclude_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text matches go; rows without text stay."""
    return df.where(~matches(strip(column), pattern, when_null=False))


def looks_failed(c: ColumnOrName) -> Column:
    """Failure text, ``NA``, or no text at all."""
    return matches(strip(F.lower(as_col(c))), FAILURE_OR_NA, when_null=True)


def says_failed(c: ColumnOrName) -> Column:
    """Failure text proper; ``NA`` and missing text do not count."""
    return matches(c, FAILURE, when_null=False)


def is_refund_entry(credit: ColumnOrName, description: ColumnOrName) -> Column:
    """A credit whose description has the layout of a refund."""
    return as_col(credit).isNotNull() & matches(description, REFUND_ENTRY)


def has_bill_prefix(c: ColumnOrName) -> Column:
    return F.coalesce(F.startswith(as_col(c), F.lit(BILL_PREFIX)), F.lit(False))


def split_on(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """``(rows that pass, all other rows)``; a null test counts as not passing."""
    passes = F.coalesce(test, F.lit(False))
    return df.where(passes), df.where(~passes)


def unset_or_from(c: ColumnOrName, start: Day) -> Column:
    """No expiry date was ever set, or it is on or after ``start``."""
    col = as_col(c)
    return is_unset_year(col) | (col >= F.lit(start).cast("date"))


def unset_or_between(c: ColumnOrName, start: Day, end: Day) -> Column:
    return is_unset_year(c) | in_days(c, start, end)


def set_and_before(c: ColumnOrName, start: Day) -> Column:
    col = as_col(c)
    return ~is_unset_year(col) & (col < F.lit(start).cast("date"))


def set_and_between(c: ColumnOrName, start: Day, end: Day) -> Column:
    return ~is_unset_year(c) & in_days(c, start, end)


def reference_not_updated(reference: ColumnOrName, own_id: ColumnOrName) -> Column:
    """The bank reference is missing or the placeholder ``0``, though the own id is there."""
    ref = null_words_to_null(reference)
    missing = F.coalesce(ref == "0", F.lit(True))
    return missing & null_words_to_null(own_id).isNotNull()

