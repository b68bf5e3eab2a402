"""What the ledger-against-statement reconciliations share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.columns import select_existing, tagged, union_aligned
from tallybook.operators.summary import count_frame, product
from tallybook.plans.result import Result

# Bucket names of the ledger reconciliations.
MATCHING = "matching_trans"
NOT_IN_LEDGER = "not_in_ledger"
NOT_IN_STATEMENT = "not_in_statement"
REFUNDS = "matching_refunds"
NOT_REFUNDED = "failed_not_refunded"
AMOUNT_MISMATCH = "amount_mismatch"
REFUND_MISMATCH = "refund_amount_mismatch"
CREDIT_NOT_IN_STATEMENT = "Credit_Trans_in_Ledger_not_in_Stmnt"
# Not part of the fixed values: rows that would otherwise be in no bucket.
MATCHED_NO_COMMISSION = "MATCHED_NO_COMMISSION"

# Rows that belong to a bucket of other rows, and that no plan looks at.
FAILED_PAIR = "FAILED_PAIR"
REFUNDED = "REFUNDED"
NON_TRANSACTION_ROW = "NON_TRANSACTION"

SETTLED = (MATCHING, REFUNDS)

#: Optional columns of the inputs that the rows of a result carry on: the number of the ledger row, of the
#: statement row, and of a second ledger row that a result row also accounts for.
LEDGER_ROW, STATEMENT_ROW, LINKED_ROW = "LEDGER_ROW", "STATEMENT_ROW", "LINKED_ROW"


def numbers_of(df: DataFrame, name: str, alias: str | None = None) -> list[Column]:
    """The column with row numbers, if the input has one."""
    return [F.col(name).alias(alias or name)] if name in df.columns else []


def stack(
    buckets: Mapping[str, DataFrame],
    columns: Sequence[str],
    classified: Sequence[DataFrame] = (),
) -> DataFrame:
    """All buckets in one frame, with the listed columns that any of them has.

    ``classified`` frames carry their ``CATEGORY`` already: rows of one join
    that differ only in their bucket are told apart by a column, so that the
    join runs once.
    """
    names = ["CATEGORY", *columns, LEDGER_ROW, STATEMENT_ROW, LINKED_ROW]
    parts = [select_existing(df, names) for df in classified]
    parts += [tagged(select_existing(df, names), name) for name, df in buckets.items()]
    return select_existing(union_aligned(*parts), names)


def category(test: Column, yes: str, no: str) -> Column:
    """One of two bucket names; a null test gives ``no``."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def counts(
    *parts: tuple[DataFrame, Mapping[str, Column]], total: DataFrame | None = None
) -> DataFrame:
    """``(metric, value)`` rows, one aggregation per input frame."""
    frames = [count_frame(df, tests) for df, tests in parts]
    if total is not None:
        frames.append(total)
    return union_aligned(*frames)


def by_key(amounts: DataFrame, *names: str) -> DataFrame:
    """Sums per ``key`` of rows per ``(key, amount)``, and of the pairs whose amounts are equal.

    ``l`` and ``s`` count the rows of the two sides; a null key or amount is equal to nothing.
    """
    usable = F.col("key").isNotNull() & F.col("amount").isNotNull()
    equal = F.when(usable, product("l", "s")).otherwise(F.lit(0))
    return amounts.groupBy("key").agg(
        *[F.sum(n).alias(n) for n in names], F.sum(equal).alias("equal")
    )


def count_buckets(rows: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sizes of groups of buckets, in one pass over the result rows."""
    return count_frame(
        rows, {metric: F.col("CATEGORY").isin(*cats) for metric, cats in names.items()}
    )


def row_count(name: str) -> Mapping[str, Column]:
    return {name: F.lit(True)}


def result(rows: DataFrame, numbers: DataFrame, *settled: str) -> Result:
    """``settled``: further buckets that are no exceptions."""
    return Result(rows, numbers, (*SETTLED, *settled))
