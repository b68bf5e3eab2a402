"""Daily totals of a booking statement against the daily balance of the ledger."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.dates import parse_date
from tallybook.functions.numbers import close_to, is_unreadable, to_decimal
from tallybook.functions.status import FAILED, SUCCESS, lower_status
from tallybook.operators.columns import select_existing, union_aligned, upper_headers
from tallybook.operators.match import lookup
from tallybook.operators.rules import MATCHED, MISMATCHED, UNCLASSIFIED
from tallybook.plans.ledger_common import (
    AMOUNT_MISMATCH,
    MATCHING,
    count_buckets,
    counts,
    result,
    row_count,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns

# Result columns, date layouts and amount columns.
COLUMNS = (
    "TKT. NUMBER",
    "AMOUNT_LEDGER",
    "AMOUNT_STATEMENT",
    "BOOKED DATE",
    "TICKET AMOUNT",
    "SERVICE TAX",
    "COMM.",
    "COMM TDS",
    "FINAL_AMOUNT",
    "MAPPING_STATUS",
)
BOOKED_LAYOUTS = ("dd-MM-yyyy HH:mm",)
BALANCE_LAYOUTS = ("dd-MM-yyyy",)
PARTS = ("TICKET AMOUNT", "SERVICE TAX", "COMM.", "COMM TDS")


def prepare(ledger: DataFrame, statement: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``ledger(DAY, USED)`` and the statement with ``DAY``, ``STATUS`` and ``FINAL_AMOUNT``.

    Both have ``UNREADABLE``: a text that is no amount was left out of the row. The ledger
    keeps its date as it is written in ``BOOKED DATE``, for rows that belong to no day.
    """
    led, stm = upper_headers(as_text(ledger)), upper_headers(as_text(statement))
    require_columns(led, ("BALANCE DATE", "USED AMOUNT"), "ledger")
    require_columns(stm, ("BOOKED DATE", "STATUS", *PARTS), "statement")
    led = led.select(
        parse_date("BALANCE DATE", BALANCE_LAYOUTS).alias("DAY"),
        to_decimal("USED AMOUNT").alias("USED"),
        as_col("BALANCE DATE").alias("BOOKED DATE"),
        is_unreadable("USED AMOUNT").alias("UNREADABLE"),
    )
    ticket, tax, comm, tds = (to_decimal(c) for c in PARTS)
    stm = stm.withColumns(
        {
            "DAY": parse_date("BOOKED DATE", BOOKED_LAYOUTS),
            "STATUS": lower_status("STATUS"),
            "FINAL_AMOUNT": (ticket + tax) - (comm - tds),
            "UNREADABLE": reduce(or_, map(is_unreadable, PARTS)),
        }
    )
    return led, stm


def daily_net(statement: DataFrame) -> DataFrame:
    """Per day the total of successful bookings minus that of failed ones.

    ``NET_UNREADABLE`` tells whether one of them has an amount that cannot be read.
    """
    known = statement.where(F.col("DAY").isNotNull() & F.col("STATUS").isNotNull())

    def total(status: str):
        amount = F.when(F.col("STATUS") == status, F.col("FINAL_AMOUNT"))
        return F.coalesce(F.sum(amount), F.lit(0).cast("decimal(1,0)"))

    counted = F.col("STATUS").isin(SUCCESS, FAILED)
    return known.groupBy("DAY").agg(
        (total(SUCCESS) - total(FAILED)).alias("AMOUNT_STATEMENT"),
        F.bool_or(counted & F.col("UNREADABLE")).alias("NET_UNREADABLE"),
    )


def daily_used(ledger: DataFrame) -> DataFrame:
    return (
        ledger.where(F.col("DAY").isNotNull())
        .groupBy("DAY")
        .agg(
            F.coalesce(F.sum("USED"), F.lit(0).cast("decimal(1,0)")).alias(
                "AMOUNT_LEDGER"
            ),
            F.bool_or("UNREADABLE").alias("USED_UNREADABLE"),
        )
    )


def compare_days(net: DataFrame, used: DataFrame) -> DataFrame:
    """Full outer join of the two daily totals with a verdict; a missing side counts as zero.

    Both inputs hold one row per day. A day with an amount that cannot be read has no
    verdict: its totals do not tell whether it agrees.
    """
    days = net.join(used, "DAY", "full").select(
        "DAY",
        F.coalesce(F.col("AMOUNT_STATEMENT").cast("double"), F.lit(0.0)).alias(
            "AMOUNT_STATEMENT"
        ),
        F.coalesce(F.col("AMOUNT_LEDGER").cast("double"), F.lit(0.0)).alias(
            "AMOUNT_LEDGER"
        ),
        F.coalesce(F.greatest("NET_UNREADABLE", "USED_UNREADABLE"), F.lit(False)).alias(
            "UNREADABLE"
        ),
    )
    same = close_to("AMOUNT_STATEMENT", "AMOUNT_LEDGER")
    verdict = (
        F.when(F.col("UNREADABLE"), F.lit(UNCLASSIFIED))
        .when(same, F.lit(MATCHED))
        .otherwise(F.lit(MISMATCHED))
    )
    return days.withColumn("MAPPING_STATUS", verdict).drop("UNREADABLE")


def attach_verdict(statement: DataFrame, days: DataFrame) -> DataFrame:
    """Every booking with its day's totals and verdict; the day table is small and stays a lookup."""
    return lookup(statement, days.withColumnRenamed("DAY", "__day"), "DAY", "__day")


def reconcile_daily(ledger: DataFrame, statement: DataFrame) -> tuple[Result, DataFrame]:
    """The reconciliation, and the day comparison itself, which also shows ledger-only days.

    Ledger rows without a readable date or amount are ``UNCLASSIFIED`` rows of the result.
    """
    led, stm = prepare(ledger, statement)
    days = compare_days(daily_net(stm), daily_used(led))
    verdict = F.col("MAPPING_STATUS")
    rows = attach_verdict(stm, days).withColumn(
        "CATEGORY",
        F.when(verdict == MATCHED, F.lit(MATCHING))
        .when(verdict == MISMATCHED, F.lit(AMOUNT_MISMATCH))
        # a booking without a readable date belongs to no day, and some days have no verdict
        .otherwise(F.lit(UNCLASSIFIED)),
    )
    rejected = led.where(F.col("UNREADABLE") | F.col("DAY").isNull()).select(
        F.lit(UNCLASSIFIED).alias("CATEGORY"),
        "BOOKED DATE",
        F.col("USED").cast("double").alias("AMOUNT_LEDGER"),
        F.lit(UNCLASSIFIED).alias("MAPPING_STATUS"),
    )
    names = ["CATEGORY", *COLUMNS]
    rows = select_existing(union_aligned(select_existing(rows, names), rejected), names)
    numbers = counts(
        (led, {**row_count("ledger_count"), "credit_count": F.col("USED") < 0}),
        (stm, row_count("statement_count")),
        total=count_buckets(
            rows,
            {"matched_trans_count": [MATCHING], "failed_trans_count": [AMOUNT_MISMATCH]},
        ),
    )
    return replace(result(rows, numbers), days=days), days
