"""Ledger against statement where a commission row points back to the row it belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.numbers import amounts_equal, to_decimal
from tallybook.functions.text import key_of, strip
from tallybook.operators.columns import upper_headers
from tallybook.operators.match import (
    drop_explained,
    exact,
    inner_match,
    missing_from,
    opaque,
)
from tallybook.operators.rules import UNCLASSIFIED
from tallybook.operators.summary import one_if, product, stacked_sums, totals
from tallybook.plans.ledger_common import (
    AMOUNT_MISMATCH,
    LEDGER_ROW,
    LINKED_ROW,
    MATCHED_NO_COMMISSION,
    MATCHING,
    NOT_IN_LEDGER,
    NOT_IN_STATEMENT,
    STATEMENT_ROW,
    by_key,
    category,
    numbers_of,
    result,
    stack,
)
from tallybook.plans.result import Result
from tallybook.sources.files import as_text, require_columns

# Result columns, in order, and the text that stands for a missing id.
COLUMNS = (
    "LDG_TID",
    "COMMISSION_TID",
    "COMM_AMT",
    "LDG_AMOUNT",
    "STMT_AMOUNT",
    "DATE",
)
NO_ID = "NA"


def prepare(ledger: DataFrame, statement: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with typed columns; a statement row without an id has a null ``STMT_TID``."""
    led, stm = upper_headers(as_text(ledger)), upper_headers(as_text(statement))
    require_columns(led, ("TID", "REFERENCE TID", "DR", "CR"), "ledger")
    require_columns(stm, ("IMWTID", "AMOUNT"), "statement")
    led = led.select(
        key_of("TID").alias("LDG_TID"),
        key_of("REFERENCE TID").alias("PARENT_TID"),
        to_decimal("DR").alias("LDG_AMOUNT"),
        to_decimal("CR").alias("COMM_AMT"),
        *([as_col("DATE").alias("LDG_DATE")] if "DATE" in led.columns else []),
        *numbers_of(led, LEDGER_ROW),
    )
    stm = stm.select(
        F.when(strip("IMWTID") != NO_ID, strip("IMWTID")).alias("STMT_TID"),
        to_decimal("AMOUNT").alias("STMT_AMOUNT"),
        *([as_col("DATE").alias("STMT_DATE")] if "DATE" in stm.columns else []),
        *numbers_of(stm, STATEMENT_ROW),
    )
    return led, stm


def children(parents: DataFrame, candidates: DataFrame) -> DataFrame:
    """Parent rows joined to the ledger rows that name them as their reference.

    Parents come from a join on the same id. They are shuffled once more, since
    a reference that very many rows name can only be split that way.
    """
    child = candidates.select(
        F.col("LDG_TID").alias("COMMISSION_TID"),
        F.col("PARENT_TID").alias("CHILD_OF"),
        F.col("COMM_AMT").alias("CHILD_AMT"),
        *numbers_of(candidates, LEDGER_ROW, LINKED_ROW),
    )
    return (
        parents.drop("COMM_AMT")
        .join(child, opaque("LDG_TID") == F.col("CHILD_OF"))
        .withColumnRenamed("CHILD_AMT", "COMM_AMT")
    )


def reconcile_commission(ledger: DataFrame, statement: DataFrame) -> Result:
    led, stm = prepare(ledger, statement)
    both = inner_match(led, stm, "LDG_TID", "STMT_TID", exact)
    agree = amounts_equal("LDG_AMOUNT", "STMT_AMOUNT")
    ledger_only = missing_from(led, stm, "LDG_TID", "STMT_TID", exact)
    paired = children(both, ledger_only).withColumn(
        "CATEGORY", category(agree, MATCHING, AMOUNT_MISMATCH)
    )
    parents = ledger_only.select("PARENT_TID")
    # A ledger-only row is explained if its reference is any matched row.
    unexplained = drop_explained(
        ledger_only, (both, "LDG_TID"), key="PARENT_TID", form=exact
    )

    def dated(df: DataFrame, column: str) -> DataFrame:
        return df.withColumnRenamed(column, "DATE")

    # an unequal pair is a mismatch also without a commission row
    unpaired = missing_from(both, parents, "LDG_TID", "PARENT_TID", exact).withColumn(
        "CATEGORY", category(agree, MATCHED_NO_COMMISSION, AMOUNT_MISMATCH)
    )
    has_id = F.col("STMT_TID").isNotNull()
    statement_only = missing_from(stm, led, "STMT_TID", "LDG_TID", exact).withColumn(
        "CATEGORY", category(has_id, NOT_IN_LEDGER, UNCLASSIFIED)
    )
    rows = stack(
        {NOT_IN_STATEMENT: dated(unexplained, "LDG_DATE")},
        COLUMNS,
        [
            dated(paired, "LDG_DATE"),
            dated(unpaired, "LDG_DATE"),
            dated(statement_only, "STMT_DATE").withColumnRenamed("STMT_TID", "LDG_TID"),
        ],
    )
    return result(rows, count_commissions(led, stm))


def count_commissions(led: DataFrame, stm: DataFrame) -> DataFrame:
    """The counts, from one row per id and amount, then one per id, joined with the number of its children."""
    has_commission = F.col("COMM_AMT").isNotNull() & (F.col("COMM_AMT") != 0)
    amounts = stacked_sums(
        ["key", "amount"],
        (
            led,
            [F.col("LDG_TID"), F.col("LDG_AMOUNT")],
            {"l": F.lit(1), "l_credit": one_if(has_commission)},
        ),
        (
            stm,
            [F.col("STMT_TID"), F.col("STMT_AMOUNT")],
            {"s": one_if(F.col("STMT_TID").isNotNull())},
        ),
    )
    keys = by_key(amounts, "l", "l_credit", "s")
    # ledger rows that the statement does not have, by the row that they point to
    pointers = led.groupBy("LDG_TID", "PARENT_TID").agg(F.count("*").alias("n"))
    known = keys.where("s > 0").select(F.col("key").alias("of_both"))
    children = (
        pointers.join(known, F.col("LDG_TID") == F.col("of_both"), "left")
        .where(F.col("of_both").isNull())
        .groupBy("PARENT_TID")
        .agg(F.sum("n").alias("children"))
    )
    rows = keys.join(children, F.col("key") == F.col("PARENT_TID"), "full")
    numbers = {n: F.coalesce(n, F.lit(0)) for n in ("l", "l_credit", "s", "equal", "children")}
    rows = rows.select("key", *[c.alias(n) for n, c in numbers.items()])
    known = F.col("key").isNotNull()
    pairs = F.when(known, product("l", "s")).otherwise(F.lit(0))
    unequal = pairs - F.col("equal")
    alone = F.when(known & (F.col("l") == 0), F.col("s")).otherwise(F.lit(0))
    # their parent is no matched row, or they have none
    orphans = F.when(pairs > 0, F.lit(0)).otherwise(F.col("children"))
    return totals(
        rows,
        {
            "ledger_count": F.col("l"),
            "ledger_credit_count": F.col("l_credit"),
            "statement_count": F.col("s"),
            "matched_trans_count": product("equal", "children"),
            "amount_mismatch_shown_count": unequal * F.greatest("children", F.lit(1)),
            # every unequal pair is a failure, also one without a commission row to show
            "failed_trans_count": alone + orphans + unequal,
        },
    )
