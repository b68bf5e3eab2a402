"""Ledger against statement where a failed transaction is made good by a separate ledger row."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.dates import MONTH_FIRST_LAYOUTS, date_text, parse_date
from tallybook.functions.status import FAILED, SUCCESS, ContainsStatus, lower_status
from tallybook.functions.text import capture, strip
from tallybook.operators.columns import rename_existing, with_prefix
from tallybook.operators.match import (
    drop_explained,
    inner_match,
    missing_from,
    stripped,
)
from tallybook.operators.summary import one_if, product, stacked_sums, totals
from tallybook.plans.ledger_common import (
    FAILED_PAIR,
    LEDGER_ROW,
    MATCHING,
    NOT_IN_LEDGER,
    NOT_IN_STATEMENT,
    NOT_REFUNDED,
    REFUNDS,
    numbers_of,
    result,
    stack,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns

# Result columns, header variants, and where refunds are announced.
COLUMNS = (
    "TXNID",
    "AMOUNT",
    "COMM",
    "TDS",
    "TYPE",
    "DATE",
    "REFID",
    "STATUS",
    "REFUND_TXNID",
    "REFUNDED_DATE",
)
LEDGER_HEADERS = {"COMM/SHARE": "COMM", "REFUNDTXNID": "REFUND_TXNID"}
STATEMENT_HEADERS = {"NET COMMISSION": "COMM"}
REFUND_DATE = r"Date :\s*(\d{4}-\d{2}-\d{2})"
REFUND_ID = r"Txnid(\d+)"
REFUND_COLUMN = "REFUNDTXNID"
STATUS_IN_TEXT = ContainsStatus("refunded", found=FAILED, other=SUCCESS)


def prepare(
    ledger: DataFrame, statement: DataFrame, refund_in_column: bool
) -> tuple[DataFrame, DataFrame]:
    """Canonical headers, dates and refund ids. ``refund_in_column`` tells the two layouts apart:
    a column with the id and a status text to search, or one free text with date and id."""
    led = rename_existing(as_text(ledger), LEDGER_HEADERS)
    stm = rename_existing(as_text(statement), STATEMENT_HEADERS)
    require_columns(led, ("TXNID", "TYPE"), "ledger")
    require_columns(stm, ("TXNID", "STATUS"), "statement")
    if "DATE" in led.columns:
        led = led.withColumn("DATE", date_text(parse_date("DATE", MONTH_FIRST_LAYOUTS)))
    changes = {"REFID": strip("REFID")} if "REFID" in stm.columns else {}
    if "DATE" in stm.columns:
        changes["DATE"] = date_text(parse_date("DATE", MONTH_FIRST_LAYOUTS))
    note = as_col("REFUND") if "REFUND" in stm.columns else F.lit(None).cast("string")
    changes["REFUNDED_DATE"] = capture(note, REFUND_DATE)
    if refund_in_column:
        changes["STATUS"] = STATUS_IN_TEXT.apply("STATUS")
        changes["REFUND_TXNID"] = strip(REFUND_COLUMN)
    else:
        changes["REFUND_TXNID"] = capture(note, REFUND_ID)
    return led, stm.withColumns(changes)


def is_failed():
    return F.coalesce(lower_status("STATUS") == FAILED, F.lit(False))


def reconcile_refunds(
    ledger: DataFrame,
    statement: DataFrame,
    refund_in_column: bool = False,
    key_form=stripped,
) -> Result:
    led, stm = prepare(ledger, statement, refund_in_column)
    types = led.select(as_col("TXNID").alias("L_TXNID"), "TYPE", *numbers_of(led, LEDGER_ROW))
    if "TYPE" in stm.columns:
        stm = stm.drop("TYPE")
    matched = inner_match(stm, types, "TXNID", "L_TXNID", key_form)
    failed = stm.where(is_failed())
    refund_rows = missing_from(types, stm, "L_TXNID", "TXNID")
    buckets = {
        MATCHING: matched.where(
            F.coalesce(F.col("STATUS") != FAILED, F.lit(True))
        ),
        NOT_IN_LEDGER: missing_from(stm, led, "TXNID", "TXNID"),
        REFUNDS: inner_match(failed, refund_rows, "REFUND_TXNID", "L_TXNID"),
        NOT_REFUNDED: missing_from(failed, refund_rows, "REFUND_TXNID", "L_TXNID"),
        # neither a transaction of the statement nor the refund of a failed one
        NOT_IN_STATEMENT: drop_explained(
            led, (stm, "TXNID"), (failed, "REFUND_TXNID"), key="TXNID", form=stripped
        ),
    }
    rows = stack(buckets, COLUMNS)
    numbers = count_refunds(led, stm, key_form)
    # the ledger's own row of a failed transaction, whose refund or lack of one is shown
    pairs = matched.where(F.col("STATUS") == FAILED)
    return replace(
        result(rows, numbers, FAILED_PAIR), unplaced=stack({FAILED_PAIR: pairs}, COLUMNS)
    )


def count_refunds(led: DataFrame, stm: DataFrame, key_form=stripped) -> DataFrame:
    """The counts, from one row per key: pairs are products of what both sides have of it."""
    keys = stacked_sums(
        ["key"],
        (
            led,
            [key_form("TXNID")],
            {"l": F.lit(1), "l_credit": one_if(lower_status("TYPE") == "credit")},
        ),
        (
            stm,
            [key_form("TXNID")],
            {
                "s": F.lit(1),
                "s_failed": one_if(is_failed()),
                "s_open": one_if(F.coalesce(F.col("STATUS") != FAILED, F.lit(True))),
            },
        ),
    )
    known = F.col("key").isNotNull()
    return totals(
        keys,
        {
            "ledger_count": F.col("l"),
            "ledger_credit_count": F.col("l_credit"),
            "statement_count": F.col("s"),
            "failed_trans_count": F.col("s_failed"),
            # also of failed transactions, which the matching bucket does not have
            "matched_trans_count": F.when(known, product("l", "s")),
            "matching_trans_count": F.when(known, product("l", "s_open")),
        },
    )


def refund_links(failed: DataFrame, ledger_only: DataFrame) -> DataFrame:
    """Failed statement rows with the ledger row that refunds them, ledger columns prefixed ``L_``."""
    return inner_match(
        failed, with_prefix(ledger_only, "L_"), "REFUND_TXNID", "L_TXNID"
    )
