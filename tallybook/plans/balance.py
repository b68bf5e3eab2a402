"""Proof that a reconciliation accounts for every input row.

Both inputs are numbered and written once, and an observation counts their rows on the way. The plan runs
on the numbered inputs, and its result rows carry the numbers of the rows they come from. What remains to be
checked needs no join: the numbers found in the written result, each counted once, must be as many as
the rows that went in. Numbers are counted in bitmaps of 32,768 bits, which the map tasks fill: a
ledger row that matches a million statement rows sets one bit a million times and is sent once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.errors import UnbalancedError
from tallybook.operators.columns import select_existing
from tallybook.operators.rejects import accepted
from tallybook.plans.ledger_common import LEDGER_ROW, LINKED_ROW, STATEMENT_ROW
from tallybook.plans.ledger_recon import reconcile_ledger
from tallybook.sources.staging import staged

#: Which result columns hold row numbers of a side.
SIDES = {"ledger": (LEDGER_ROW, LINKED_ROW), "statement": (STATEMENT_ROW,)}
ROWS_IN, ROWS_PLACED = "ROWS_IN", "ROWS_PLACED"


@dataclass(frozen=True)
class Balance:
    """``rows``: the written result with row numbers. ``table``: ``(SIDE, CATEGORY, n)``, input rows of a
    side that a bucket accounts for, and in ``ROWS_IN`` and ``ROWS_PLACED`` of all buckets."""

    rows: DataFrame
    table: DataFrame
    rows_in: dict[str, int]
    rows_placed: dict[str, int]

    def missing(self) -> dict[str, int]:
        """Input rows that no result row accounts for, by side."""
        return {side: n - self.rows_placed[side] for side, n in self.rows_in.items()}


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` with a number for each row, written to the shared folder, and how many rows it has."""
    seen = Observation()
    rows = df.withColumn(name, F.monotonically_increasing_id())
    kept = staged(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    return kept, seen.get["n"]


def _bitmaps(rows: DataFrame, side: str) -> DataFrame:
    names = select_existing(rows, SIDES[side]).columns
    numbers = F.array_compact(F.array(*[F.col(n).cast("bigint") for n in names]))
    found = rows.select("CATEGORY", F.explode(numbers).alias("row"))
    # bits are numbered from the start of their bucket
    return found.groupBy("CATEGORY", F.bitmap_bucket_number("row").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits")
    )


def accounted(rows: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
    """Different row numbers of a side by ``CATEGORY``, and in one row those of all of them."""
    bitmaps = _bitmaps(rows, side)
    by_category = bitmaps.groupBy("CATEGORY").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    merged = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    whole = merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
    return by_category, whole


def reconcile_balanced(service: str, ledger: DataFrame, statement: DataFrame) -> Balance:
    """The result of ``reconcile_ledger`` on numbered inputs, written, with its row balance.

    Raises ``UnbalancedError`` if an input row is in no result row. Lines that do not fit their file's
    layout are no rows. For the services that compare rows; daily totals have no ledger rows to carry.
    """
    led, n_led = numbered(accepted(ledger), LEDGER_ROW)
    stm, n_stm = numbered(accepted(statement), STATEMENT_ROW)
    rows = staged(reconcile_ledger(service, led, stm, stage=True).rows())
    rows_in, rows_placed, parts = {"ledger": n_led, "statement": n_stm}, {}, []
    for side, n in rows_in.items():
        by_category, whole = accounted(rows, side)
        rows_placed[side] = whole.first()["n"]
        parts.append(by_category.select(F.lit(side).alias("SIDE"), "CATEGORY", "n"))
        totals = [(side, ROWS_IN, n), (side, ROWS_PLACED, rows_placed[side])]
        parts.append(ledger.sparkSession.createDataFrame(totals, "SIDE string, CATEGORY string, n long"))
    balance = Balance(rows, parts[0], rows_in, rows_placed)
    lost = {side: n for side, n in balance.missing().items() if n}
    if lost:
        raise UnbalancedError(f"{service}: rows in no bucket: {lost}")
    for part in parts[1:]:
        balance = Balance(rows, balance.table.unionByName(part), rows_in, rows_placed)
    return balance
