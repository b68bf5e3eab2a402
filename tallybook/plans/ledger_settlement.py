"""Ledger rows that settle groups of statement rows, each followed by its commission row."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.numbers import amounts_equal, to_decimal
from tallybook.functions.status import FAILED, lower_status
from tallybook.functions.text import drop_point_zero, matches, strip
from tallybook.operators.columns import upper_headers, with_prefix
from tallybook.operators.filters import NON_TRANSACTION, exclude_matching, split_on
from tallybook.operators.match import opaque, own_shuffle
from tallybook.operators.rules import UNCLASSIFIED
from tallybook.operators.summary import one_if, product, stacked_sums, totals
from tallybook.plans.ledger_common import (
    AMOUNT_MISMATCH,
    LEDGER_ROW,
    LINKED_ROW,
    MATCHED_NO_COMMISSION,
    MATCHING,
    NON_TRANSACTION_ROW,
    NOT_IN_LEDGER,
    NOT_IN_STATEMENT,
    STATEMENT_ROW,
    category,
    numbers_of,
    result,
    stack,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns
from tallybook.sources.staging import staged

# Result columns, in order.
COLUMNS = (
    "SETTLED_ID",
    "COMMISSION_SNO",
    "SERIALNUMBER",
    "ACKNO",
    "UTR",
    "AMOUNT_LEDGER",
    "AMOUNT_STATEMENT",
    "COMMISSION_STATEMENT",
    "TYPE",
    "STATUS",
    "DATE",
    "SUM_AMOUNT",
)
TEXT_IDS = ("SERIALNUMBER", "ACKNO", "UTR")


def _number(name: str):
    return drop_point_zero(strip(name)).try_cast("bigint")


def prepare(ledger: DataFrame, statement: DataFrame) -> tuple[DataFrame, DataFrame]:
    led = upper_headers(as_text(ledger))
    stm = upper_headers(as_text(statement))
    require_columns(led, ("SNO", "TXNTYPE", "TYPE", "AMOUNT"), "ledger")
    require_columns(stm, ("SETTLED_ID", "AMOUNT", "STATUS"), "statement")
    led = exclude_matching(led, "TXNTYPE", NON_TRANSACTION).select(
        _number("SNO").alias("SNO"),
        "TYPE",
        to_decimal("AMOUNT").alias("AMOUNT_LEDGER"),
        "DATE",
        *numbers_of(led, LEDGER_ROW),
    )
    stm = stm.select(
        _number("SETTLED_ID").alias("SETTLED_ID"),
        to_decimal("AMOUNT").alias("AMOUNT_STATEMENT"),
        as_col("COMMISSION").alias("COMMISSION_STATEMENT"),
        "STATUS",
        *[drop_point_zero(c).alias(c) for c in TEXT_IDS if c in stm.columns],
        *numbers_of(stm, STATEMENT_ROW),
    )
    return led, stm


def non_transactions(ledger: DataFrame) -> DataFrame:
    """Ledger rows that ``prepare`` leaves out: settlements, charges and mini statements."""
    led = upper_headers(as_text(ledger))
    return led.where(matches(strip("TXNTYPE"), NON_TRANSACTION)).select(
        _number("SNO").alias("SETTLED_ID"),
        to_decimal("AMOUNT").alias("AMOUNT_LEDGER"),
        "TYPE",
        "DATE",
        *numbers_of(led, LEDGER_ROW),
    )


def settlement_totals(statement: DataFrame) -> DataFrame:
    """Statement amount per settlement; rows without a settlement take no part."""
    return (
        statement.where(F.col("SETTLED_ID").isNotNull())
        .groupBy("SETTLED_ID")
        .agg(
            F.coalesce(
                F.sum("AMOUNT_STATEMENT"), F.lit(0).cast("decimal(1,0)")
            ).alias("SUM_AMOUNT")
        )
    )


def compare_totals(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """Ledger rows with the statement total they settle (null if none) and whether it agrees."""
    totals = own_shuffle(settlement_totals(statement), "SETTLED_ID")
    return ledger.join(totals, F.col("SNO") == F.col("SETTLED_ID"), "left").select(
        *ledger.columns,
        "SUM_AMOUNT",
        amounts_equal("SUM_AMOUNT", "AMOUNT_LEDGER").alias("AGREES"),
    )


def is_idle() -> Column:
    """The ledger row settles nothing."""
    return F.col("SUM_AMOUNT").isNull()


def mark_commission(compared: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """``IS_COMMISSION`` for ledger rows that settle nothing and directly follow an agreeing one.

    Both sides get a shuffle of their own, so that rows without a readable serial
    number, which all lie in one partition, can be split. ``marked``: the rows to mark, if not all.
    """
    bases = own_shuffle(
        compared.where("AGREES")
        .select((F.col("SNO") + 1).alias("NEXT_SNO"))
        .distinct(),
        "NEXT_SNO",
    )
    follows = is_idle() & F.col("NEXT_SNO").isNotNull()
    rows = compared if marked is None else marked
    return rows.join(bases, opaque("SNO") == F.col("NEXT_SNO"), "left").select(
        *compared.columns, follows.alias("IS_COMMISSION")
    )


def with_commission(compared: DataFrame) -> DataFrame:
    """Settling ledger rows with the commission row that follows an agreeing one, prefixed ``C_``."""
    commission = with_prefix(
        compared.where(is_idle()).select("SNO", "TYPE", "DATE", *numbers_of(compared, LEDGER_ROW)),
        "C_",
    )
    # by the settling row's own number, by which the rows are shuffled already
    follows = F.col("AGREES") & (F.col("SNO") == F.try_subtract("C_SNO", F.lit(1).cast("bigint")))
    return compared.where(~is_idle()).join(commission, follows, "left")


def _with_ledger(statement: DataFrame, settled: DataFrame) -> DataFrame:
    """All statement rows with their settling ledger row and its commission row, classified.

    ``UNPLACED``: the row has no bucket of its own, because its settlement is a mismatch as a
    whole, or because it failed and its settlement is unknown.
    Serial numbers identify ledger rows, so the right side has one row per key
    and only the statement side can be hot, which a left join splits.
    """
    known = F.col("SNO").isNotNull()
    paired = F.col("C_SNO").isNotNull()
    open_ = F.coalesce(F.lower("STATUS") != FAILED, F.lit(True))
    rows = statement.join(settled, F.col("SETTLED_ID") == opaque("SNO"), "left")
    differs = known & ~F.coalesce("AGREES", F.lit(False))
    return rows.select(
        (differs | (~known & ~open_)).alias("UNPLACED"),
        F.when(differs, F.lit(AMOUNT_MISMATCH))
        .when(~known & ~open_, F.lit(UNCLASSIFIED))
        .when(~known, F.lit(NOT_IN_LEDGER))
        .when(paired, F.lit(MATCHING))
        .otherwise(F.lit(MATCHED_NO_COMMISSION))
        .alias("CATEGORY"),
        *statement.columns,
        F.col("C_SNO").alias("COMMISSION_SNO"),
        "AMOUNT_LEDGER",
        F.when(paired, F.col("C_TYPE")).otherwise(F.col("TYPE")).alias("TYPE"),
        F.when(paired, F.col("C_DATE")).otherwise(F.col("DATE")).alias("DATE"),
        *numbers_of(settled, LEDGER_ROW),
        *numbers_of(settled, f"C_{LEDGER_ROW}", LINKED_ROW),
    )


def count_settlements(led: DataFrame, stm: DataFrame, others: DataFrame) -> DataFrame:
    """The counts, from one row per serial number.

    A settlement's statement rows are matched once for each agreeing ledger row and each
    commission row that follows it. All joins are between tables grouped by serial number.
    """
    open_ = F.coalesce(F.lower("STATUS") != FAILED, F.lit(True))
    amounts = stacked_sums(
        ["SNO", "AMOUNT_LEDGER"],
        (
            led,
            [F.col("SNO"), F.col("AMOUNT_LEDGER")],
            {"l": F.lit(1), "l_credit": one_if(lower_status("TYPE") == "credit")},
        ),
        (others, [F.lit(None).cast("bigint"), F.lit(None)], {"other": F.lit(1)}),
    )
    settled = stm.groupBy("SETTLED_ID").agg(
        F.count("*").alias("s"),
        F.count_if(open_).alias("s_open"),
        F.coalesce(F.sum("AMOUNT_STATEMENT"), F.lit(0).cast("decimal(1,0)")).alias("SUM_AMOUNT"),
    )
    agrees = amounts_equal("SUM_AMOUNT", "AMOUNT_LEDGER") & F.col("SNO").isNotNull()
    # a serial number is on both sides, on one of them, or missing: a full join of grouped rows
    serials = (
        amounts.join(settled, F.col("SNO") == F.col("SETTLED_ID"), "full")
        .groupBy(F.coalesce("SNO", "SETTLED_ID").alias("id"))
        .agg(
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("l", "l_credit", "other")],
            F.coalesce(F.sum(F.when(agrees, F.col("l"))), F.lit(0)).alias("agreed"),
            *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in ("s", "s_open")],
        )
    )
    idle = F.when((F.col("s") == 0) | F.col("id").isNull(), F.col("l")).otherwise(F.lit(0))
    after = serials.where("agreed > 0").select((F.col("id") + 1).alias("next"), F.col("agreed").alias("agreed_before"), F.col("s").alias("s_before"))
    rows = serials.withColumn("idle", idle).join(after, F.col("id") == F.col("next"), "left")
    unknown = F.col("id").isNull() | (F.col("l") == 0)
    return totals(
        rows,
        {
            "ledger_count": F.col("l") + F.col("other"),
            "ledger_credit_count": F.col("l_credit"),
            "statement_count": F.col("s"),
            "matched_trans_count": product("idle", "agreed_before", "s_before"),
            "failed_trans_count": F.when(F.col("next").isNull(), F.col("idle")).otherwise(F.lit(0))
            + F.when(unknown, F.col("s_open")).otherwise(F.lit(0)),
        },
    )


def reconcile_settlement(ledger: DataFrame, statement: DataFrame, stage: bool = False) -> Result:
    """``stage`` keeps the ledger with its statement totals, which is used three times, in the shared folder."""
    led, stm = prepare(ledger, statement)
    compared = compare_totals(led, stm)
    if stage:
        compared = staged(compared)
    # rows that settle their total need no mark
    marked = mark_commission(compared, compared.where(~F.col("AGREES")))
    ledger_side = (
        marked.where(
            F.when(is_idle(), ~F.col("IS_COMMISSION")).otherwise(~F.col("AGREES"))
        )
        .withColumn("CATEGORY", category(is_idle(), NOT_IN_STATEMENT, AMOUNT_MISMATCH))
        .withColumnRenamed("SNO", "SETTLED_ID")
    )
    classified = _with_ledger(stm, with_commission(compared))
    unplaced, placed = split_on(classified, F.col("UNPLACED"))
    rows = stack({}, COLUMNS, [placed, ledger_side])
    others = {NON_TRANSACTION_ROW: non_transactions(ledger)}
    numbers = count_settlements(led, stm, others[NON_TRANSACTION_ROW])
    return replace(
        result(rows, numbers, NON_TRANSACTION_ROW),
        unplaced=stack(others, COLUMNS, [unplaced]),
        whole=stack(others, COLUMNS, [classified, ledger_side]),
    )
