"""Bank ledger against bill-payment statement, with refunds announced in the ledger text."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.dates import date_text, parse_date
from tallybook.functions.numbers import (
    amounts_equal,
    to_decimal,
    to_number,
    whole_number_text,
)
from tallybook.functions.text import capture, last_token, strip
from tallybook.operators.columns import rename_existing, upper_headers
from tallybook.operators.filters import (
    has_bill_prefix,
    is_refund_entry,
    looks_failed,
    says_failed,
)
from tallybook.operators.match import exact, inner_match, missing_from, opaque, present_in
from tallybook.operators.rules import UNCLASSIFIED
from tallybook.operators.summary import one_if, product, stacked_sums, totals
from tallybook.plans.ledger_common import (
    AMOUNT_MISMATCH,
    CREDIT_NOT_IN_STATEMENT,
    LEDGER_ROW,
    LINKED_ROW,
    MATCHING,
    NOT_IN_LEDGER,
    NOT_IN_STATEMENT,
    NOT_REFUNDED,
    REFUND_MISMATCH,
    STATEMENT_ROW,
    numbers_of,
    result,
    stack,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns

# Headers, result columns, refund reference and date layouts.
LEDGER_HEADERS = {"Chq / Ref No.": "LEDGER_REF", "Debit": "AMOUNT_LEDGER"}
STATEMENT_HEADERS = {
    "Transaction Ref ID": "STATEMENT_REF",
    "Transaction Amount(RS.)": "AMOUNT_STATEMENT",
    "NPCI Transaction Desc": "TRANSACTION_STATUS",
}
COLUMNS = (
    "TRANS_REF_ID",
    "AMOUNT_LEDGER",
    "AMOUNT_STATEMENT",
    "REFUNDED_AMOUNT",
    "TRANSACTION_STATUS",
    "ACTUAL_TRANS_DATE",
    "DATE",
)
REFUND_REFERENCE = r"REF-([A-Z0-9]+)-"
REFUND_DATE_LAYOUTS = ("MM/dd/yyyy", "ddMMyyyy")
# Not part of the fixed values: refunds of transactions that did not fail.
REFUND_OF_NOTHING = "REFUND_WITHOUT_FAILURE"


def prepare(
    ledger: DataFrame, statement: DataFrame, amount_mode: str = "integer"
) -> tuple[DataFrame, DataFrame]:
    led = upper_headers(rename_existing(as_text(ledger), LEDGER_HEADERS))
    stm = upper_headers(rename_existing(as_text(statement), STATEMENT_HEADERS))
    require_columns(led, ("LEDGER_REF", "AMOUNT_LEDGER", "CREDIT"), "ledger")
    require_columns(stm, ("STATEMENT_REF", "AMOUNT_STATEMENT"), "statement")
    clean = whole_number_text if amount_mode == "integer" else to_decimal
    led = led.select(
        strip("LEDGER_REF").alias("LEDGER_REF"),
        clean("AMOUNT_LEDGER").alias("AMOUNT_LEDGER"),
        strip("CREDIT").alias("CREDIT"),
        strip("DESCRIPTION").alias("DESCRIPTION"),
        as_col("TRANSACTION DATE").alias("LEDGER_DATE"),
        *numbers_of(led, LEDGER_ROW),
    )
    stm = stm.select(
        strip("STATEMENT_REF").alias("STATEMENT_REF"),
        clean("AMOUNT_STATEMENT").alias("AMOUNT_STATEMENT"),
        strip("TRANSACTION_STATUS").alias("TRANSACTION_STATUS"),
        as_col("TRANSACTION DATE").alias("STATEMENT_DATE"),
        *numbers_of(stm, STATEMENT_ROW),
    )
    return led, stm


def refund_entries(ledger: DataFrame) -> DataFrame:
    """Refund rows of the ledger with the reference they refund and the date in their text."""
    return ledger.where(is_refund_entry("CREDIT", "DESCRIPTION")).select(
        capture("DESCRIPTION", REFUND_REFERENCE).alias("REF_NUMBER"),
        to_number("CREDIT").alias("REFUNDED_AMOUNT"),
        date_text(parse_date(last_token("DESCRIPTION"), REFUND_DATE_LAYOUTS)).alias(
            "ACTUAL_TRANS_DATE"
        ),
        F.col("LEDGER_DATE").alias("REFUND_DATE"),
        *numbers_of(ledger, LEDGER_ROW, LINKED_ROW),
    )


def refund_amount_check(failed: DataFrame, refunds: DataFrame) -> DataFrame:
    """Failed rows with each of their refunds and whether the full amount came back.

    The failed rows come from a join on the same reference and are shuffled once
    more, so that a reference with very many refunds can be split.
    """
    same = opaque("LEDGER_REF") == F.col("REF_NUMBER")
    return failed.join(refunds.drop("ACTUAL_TRANS_DATE"), same).withColumn(
        "REFUND_AGREES", amounts_equal("REFUNDED_AMOUNT", to_number("AMOUNT_STATEMENT"))
    )


def reconcile_bills(
    ledger: DataFrame, statement: DataFrame, amount_mode: str = "integer"
) -> Result:
    led, stm = prepare(ledger, statement, amount_mode)
    refunds = refund_entries(led)
    both = inner_match(
        led.drop("CREDIT", "DESCRIPTION"), stm, "LEDGER_REF", "STATEMENT_REF", exact
    )
    agree = amounts_equal("AMOUNT_LEDGER", "AMOUNT_STATEMENT")
    equal = both.where(agree)
    failed = equal.where(looks_failed("TRANSACTION_STATUS"))
    checked = refund_amount_check(failed, refunds)
    # A full refund is attached to the failed row it belongs to. Matching it by
    # row rather than by reference alone keeps repeated references from
    # multiplying each other, and spreads a hot reference by its amounts.
    full = (
        (F.col("LEDGER_REF") == F.col("REF_NUMBER"))
        & (F.col("REFUNDED_AMOUNT") == to_number("AMOUNT_STATEMENT"))
        & looks_failed("TRANSACTION_STATUS")
        & agree
    )
    refund = refunds.select("REF_NUMBER", "REFUNDED_AMOUNT", *numbers_of(refunds, LINKED_ROW))
    open_failed = says_failed("TRANSACTION_STATUS") & F.col("REFUNDED_AMOUNT").isNull()
    matched = both.join(refund, full, "left").withColumn(
        "CATEGORY",
        F.when(~agree, F.lit(AMOUNT_MISMATCH))
        .when(open_failed, F.lit(NOT_REFUNDED))
        .otherwise(F.lit(MATCHING)),
    )

    def shown(df: DataFrame, reference: str, date: str) -> DataFrame:
        return df.withColumnsRenamed({reference: "TRANS_REF_ID", date: "DATE"})

    bills = led.where(has_bill_prefix("LEDGER_REF"))
    rows = stack(
        {
            NOT_IN_STATEMENT: shown(
                missing_from(bills, stm, "LEDGER_REF", "STATEMENT_REF", exact),
                "LEDGER_REF",
                "LEDGER_DATE",
            ),
            NOT_IN_LEDGER: shown(
                missing_from(stm, led, "STATEMENT_REF", "LEDGER_REF", exact),
                "STATEMENT_REF",
                "STATEMENT_DATE",
            ),
            REFUND_MISMATCH: shown(
                checked.where(~F.col("REFUND_AGREES")), "LEDGER_REF", "LEDGER_DATE"
            ),
            CREDIT_NOT_IN_STATEMENT: shown(
                missing_from(refunds, stm, "REF_NUMBER", "STATEMENT_REF", exact),
                "REF_NUMBER",
                "REFUND_DATE",
            ),
        },
        COLUMNS,
        [shown(matched, "LEDGER_REF", "LEDGER_DATE")],
    )
    numbers = count_bills(led, stm, refunds)
    unplaced = {UNCLASSIFIED: shown(_others(led, stm), "LEDGER_REF", "LEDGER_DATE")}
    idle = refunds_of_nothing(refunds, stm, failed).drop("ACTUAL_TRANS_DATE")
    return replace(
        result(rows, numbers),
        unplaced=stack(
            {**unplaced, REFUND_OF_NOTHING: shown(idle, "REF_NUMBER", "REFUND_DATE")}, COLUMNS
        ),
    )


def count_bills(led: DataFrame, stm: DataFrame, refunds: DataFrame) -> DataFrame:
    """The counts, from one row per reference and amount, then one per reference.

    A failed transaction meets every refund of its reference; those of its own amount are right, the
    others are mismatches.
    """
    amounts = stacked_sums(
        ["key", "amount"],
        (
            led,
            [F.col("LEDGER_REF"), F.col("AMOUNT_LEDGER")],
            {
                "l": F.lit(1),
                "l_bill": one_if(has_bill_prefix("LEDGER_REF")),
                "l_credit": one_if(F.col("CREDIT").isNotNull()),
            },
        ),
        (
            stm,
            [F.col("STATEMENT_REF"), F.col("AMOUNT_STATEMENT")],
            {"s": F.lit(1), "s_failed": one_if(looks_failed("TRANSACTION_STATUS"))},
        ),
    )
    usable = F.col("key").isNotNull() & F.col("amount").isNotNull()
    names = ("l", "l_bill", "l_credit", "s", "equal", "failed")
    amounts = amounts.withColumns(
        {
            "equal": F.when(usable, product("l", "s")).otherwise(F.lit(0)),
            "failed": F.when(usable, product("l", "s_failed")).otherwise(F.lit(0)),
        }
    )
    # refunds are compared as numbers, so amounts that are written differently may be one number
    refunded = stacked_sums(
        ["key", "number"],
        (amounts, [F.col("key"), to_number("amount")], {n: F.col(n) for n in names}),
        (refunds, [F.col("REF_NUMBER"), F.col("REFUNDED_AMOUNT")], {"refunds": F.lit(1)}),
    )
    known = F.col("key").isNotNull()
    right = F.when(known & F.col("number").isNotNull(), product("failed", "refunds"))
    keys = refunded.groupBy("key").agg(
        *[F.sum(n).alias(n) for n in (*names, "refunds")],
        F.coalesce(F.sum(right), F.lit(0)).alias("right"),
    )
    missing = F.when(known & (F.col("s") > 0), F.lit(0)).otherwise(F.col("l_bill")) + F.when(
        known & (F.col("l") > 0), F.lit(0)
    ).otherwise(F.col("s"))
    unequal = F.when(known, product("l", "s") - F.col("equal")).otherwise(F.lit(0))
    wrong = F.when(known, product("failed", "refunds") - F.col("right")).otherwise(F.lit(0))
    return totals(
        keys,
        {
            "ledger_count": F.col("l"),
            "ledger_credit_count": F.col("l_credit"),
            "statement_count": F.col("s"),
            "matched_trans_count": F.col("equal"),
            "failed_trans_count": missing + unequal + wrong,
        },
    )


def refunds_of_nothing(refunds: DataFrame, statement: DataFrame, failed: DataFrame) -> DataFrame:
    """Refunds of a reference that the statement has, but not as a failed transaction with an equal amount."""
    known = present_in(refunds, statement, "REF_NUMBER", "STATEMENT_REF", exact)
    return missing_from(known, failed, "REF_NUMBER", "LEDGER_REF", exact)


def _others(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """Ledger rows that are neither a bill nor a refund, and that the statement does not have."""
    rest = ledger.where(
        ~has_bill_prefix("LEDGER_REF") & ~F.coalesce(is_refund_entry("CREDIT", "DESCRIPTION"), F.lit(False))
    )
    return missing_from(rest, statement, "LEDGER_REF", "STATEMENT_REF", exact)
