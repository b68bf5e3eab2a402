"""Ledger against statement on one reference, with or without an amount comparison."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.numbers import amounts_equal, to_decimal, whole_number_text
from tallybook.functions.status import lower_status
from tallybook.functions.text import strip, strip_currency
from tallybook.operators.columns import upper_headers
from tallybook.operators.filters import REFUNDED_APPLICATION, split_on
from tallybook.operators.match import exact, inner_match, missing_from, stripped
from tallybook.operators.rules import UNCLASSIFIED
from tallybook.operators.summary import one_if, product, stacked_sums, totals
from tallybook.plans.ledger_common import (
    AMOUNT_MISMATCH,
    LEDGER_ROW,
    MATCHING,
    NOT_IN_LEDGER,
    NOT_IN_STATEMENT,
    REFUNDED,
    STATEMENT_ROW,
    by_key,
    category,
    numbers_of,
    result,
    stack,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns

# Result columns, in order.
AMOUNT_COLUMNS = (
    "BCID",
    "AMOUNT_STATEMENT",
    "AMOUNT_LEDGER",
    "RRN",
    "TRANSACTIONSTATUS",
    "DATE",
)
REFERENCE_COLUMNS = (
    "LDG_REFERENCE_NO",
    "STMT_REFERENCE_NO",
    "AMOUNT_LEDGER",
    "AMOUNT_STATEMENT",
    "LEDGER_DATE",
    "STATEMENT_DATE",
)


def prepare_amounts(
    ledger: DataFrame, statement: DataFrame, amount_mode: str = "integer"
) -> tuple[DataFrame, DataFrame]:
    """``amount_mode='integer'`` compares amounts cut to whole units, ``'exact'`` to the cent.

    Statement rows without a reference are left out.
    """
    led, stm = _amount_sides(ledger, statement, amount_mode)
    return led, stm.where(F.col("RRN") != "")


def _amount_sides(
    ledger: DataFrame, statement: DataFrame, amount_mode: str
) -> tuple[DataFrame, DataFrame]:
    led, stm = upper_headers(as_text(ledger)), upper_headers(as_text(statement))
    require_columns(led, ("UTR", "AMOUNT", "CR/DR"), "ledger")
    require_columns(stm, ("RRN", "AMOUNT"), "statement")
    clean = whole_number_text if amount_mode == "integer" else to_decimal
    led = led.select(
        strip("UTR").alias("UTR"),
        clean(strip_currency("AMOUNT")).alias("AMOUNT_LEDGER"),
        as_col("CR/DR").alias("SIDE"),
        "DATE",
        *numbers_of(led, LEDGER_ROW),
    )
    stm = stm.select(
        whole_number_text("RRN").alias("RRN"),
        clean(as_col("AMOUNT")).alias("AMOUNT_STATEMENT"),
        *[c for c in ("BCID", "TRANSACTIONSTATUS") if c in stm.columns],
        *numbers_of(stm, STATEMENT_ROW),
    )
    return led, stm


def reconcile_amounts(
    ledger: DataFrame, statement: DataFrame, amount_mode: str = "integer"
) -> Result:
    led, stm = _amount_sides(ledger, statement, amount_mode)
    stm, unplaced = split_on(stm, F.col("RRN") != "")
    both = inner_match(led, stm, "UTR", "RRN", exact)
    agree = amounts_equal("AMOUNT_LEDGER", "AMOUNT_STATEMENT")
    rows = stack(
        {
            # the ledger's own reference is shown in the reference column
            NOT_IN_STATEMENT: missing_from(led, stm, "UTR", "RRN", exact).withColumnRenamed(
                "UTR", "RRN"
            ),
            NOT_IN_LEDGER: missing_from(stm, led, "RRN", "UTR", exact),
        },
        AMOUNT_COLUMNS,
        [both.withColumn("CATEGORY", category(agree, MATCHING, AMOUNT_MISMATCH))],
    )
    numbers = count_amounts(led, stm, unplaced)
    # without a reference nothing can be said about a statement row
    return replace(
        result(rows, numbers), unplaced=stack({UNCLASSIFIED: unplaced}, AMOUNT_COLUMNS)
    )


def count_amounts(led: DataFrame, stm: DataFrame, unplaced: DataFrame) -> DataFrame:
    """The counts, from one row per reference and amount, then one per reference."""
    amounts = stacked_sums(
        ["key", "amount"],
        (
            led,
            [F.col("UTR"), F.col("AMOUNT_LEDGER")],
            {"l": F.lit(1), "l_credit": one_if(lower_status("SIDE") == "cr")},
        ),
        (stm, [F.col("RRN"), F.col("AMOUNT_STATEMENT")], {"s": F.lit(1)}),
        (unplaced, [F.col("RRN"), F.col("AMOUNT_STATEMENT")], {"blank": F.lit(1)}),
    )
    keys = by_key(amounts, "l", "l_credit", "s", "blank")
    alone = F.when(F.col("s") == 0, F.col("l")).otherwise(F.lit(0)) + F.when(
        F.col("l") == 0, F.col("s")
    ).otherwise(F.lit(0))
    return totals(
        keys,
        {
            "ledger_count": F.col("l"),
            "ledger_credit_count": F.col("l_credit"),
            "statement_count": F.col("s") + F.col("blank"),
            "matched_trans_count": F.col("equal"),
            "failed_trans_count": alone,
        },
    )


def prepare_references(
    ledger: DataFrame, statement: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ledger, statement without refunded rows, refunded rows)``."""
    led, stm = upper_headers(as_text(ledger)), upper_headers(as_text(statement))
    require_columns(led, ("REFERENCE NO",), "ledger")
    require_columns(stm, ("REFERENCE NO", "PAYMENT STATUS"), "statement")
    refunded, clean = split_on(stm, as_col("PAYMENT STATUS") == REFUNDED_APPLICATION)
    led = led.select(
        strip("REFERENCE NO").alias("LDG_REFERENCE_NO"),
        as_col("UTIITSL AMOUNT").alias("AMOUNT_LEDGER"),
        as_col("LOT DATE").alias("LEDGER_DATE"),
        *numbers_of(led, LEDGER_ROW),
    )
    clean, refunded = (
        df.select(
            strip("REFERENCE NO").alias("STMT_REFERENCE_NO"),
            as_col("RES AMOUNT").alias("AMOUNT_STATEMENT"),
            as_col("TRANS DATE").alias("STATEMENT_DATE"),
            *numbers_of(df, STATEMENT_ROW),
        )
        for df in (clean, refunded)
    )
    return led, clean, refunded


def reconcile_references(ledger: DataFrame, statement: DataFrame) -> Result:
    led, stm, refunded = prepare_references(ledger, statement)
    keys = ("LDG_REFERENCE_NO", "STMT_REFERENCE_NO")
    rows = stack(
        {
            MATCHING: inner_match(led, stm, *keys, stripped),
            NOT_IN_STATEMENT: missing_from(led, stm, *keys, stripped),
            NOT_IN_LEDGER: missing_from(stm, led, *reversed(keys), stripped),
        },
        REFERENCE_COLUMNS,
    )
    numbers = count_references(led, stm, refunded)
    return replace(result(rows, numbers), unplaced=stack({REFUNDED: refunded}, REFERENCE_COLUMNS))


def count_references(led: DataFrame, stm: DataFrame, refunded: DataFrame) -> DataFrame:
    keys = stacked_sums(
        ["key"],
        (led, [stripped("LDG_REFERENCE_NO")], {"l": F.lit(1)}),
        (stm, [stripped("STMT_REFERENCE_NO")], {"s": F.lit(1)}),
        (refunded, [F.lit(None).cast("string")], {"refunded": F.lit(1)}),
    )
    known = F.col("key").isNotNull()
    alone_l = F.when(known & (F.col("s") > 0), F.lit(0)).otherwise(F.col("l"))
    alone_s = F.when(known & (F.col("l") > 0), F.lit(0)).otherwise(F.col("s"))
    return totals(
        keys,
        {
            "ledger_count": F.col("l"),
            "statement_count": F.col("s") + F.col("refunded"),
            "matched_trans_count": F.when(known, product("l", "s")),
            # refunded applications are failed transactions as well
            "failed_trans_count": alone_l + alone_s + F.col("refunded"),
        },
    )
