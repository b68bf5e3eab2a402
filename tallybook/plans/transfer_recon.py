"""Bank-transfer service: a single internal table, no ledger flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import TRANSFER_CODES
from tallybook.functions.dates import Day, in_days
from tallybook.functions.labels import label
from tallybook.operators.columns import select_existing
from tallybook.operators.match import lookup
from tallybook.operators.rules import SETTLED_TRANSFER, TRANSFER_RULES
from tallybook.operators.summary import MatchColumns, match_summary
from tallybook.plans.hub_recon import buckets
from tallybook.plans.result import Result
from tallybook.plans.vendor_input import prepare_vendor
from tallybook.sources.staging import staged
from tallybook.sources.tables import Tables

SERVICE = "IMPS"
COLUMNS = MatchColumns(hub_status="IMPS_STATUS", ledger=None)

# Result columns, in order.
RESULT_COLUMNS = (
    "ITI_ID",
    "REFID",
    "ACTUAL_AMOUNT",
    "REQUEST_AMOUNT",
    "VENDOR_AMOUNT",
    "VENDOR_STATUS",
    "IMPS_STATUS",
    "VENDOR_DATE",
    "SERVICE_DATE",
)


def transfers(tables: Tables, start: Day, end: Day) -> DataFrame:
    """Transfers of the window that carry a bank reference, with the user's id."""
    users = tables["users"].select("id", F.col("apna_id").alias("ITI_ID"))
    rows = tables["axis_imps_trans"].where(
        in_days("post_dt", start, end)
        & F.col("utr_no").isNotNull()
        & (F.col("utr_no") != "")
    )
    return lookup(rows, users, "users_id", "id").select(
        "ITI_ID",
        F.col("utr_no").cast("string").alias("VENDOR_REFERENCE"),
        F.col("tot_amt").alias("ACTUAL_AMOUNT"),
        F.col("trans_amt").alias("REQUEST_AMOUNT"),
        F.col("post_dt").cast("date").alias("SERVICE_DATE"),
        label(F.col("status").cast("string"), TRANSFER_CODES).alias("IMPS_STATUS"),
    )


def reconcile_transfers(
    vendor_file: DataFrame,
    tables: Tables,
    start: Day,
    end: Day,
    key_mode: str = "strip",
    stage: bool = False,
) -> Result:
    """``stage`` keeps the transfers in the shared folder."""
    vendor = select_existing(
        prepare_vendor(vendor_file, SERVICE),
        ["REFID", "VENDOR_DATE", "VENDOR_STATUS", "VENDOR_AMOUNT"],
    )
    hub = transfers(tables, start, end)
    if stage:
        hub = staged(hub)
    return Result(
        buckets=buckets(hub, vendor, RESULT_COLUMNS, TRANSFER_RULES, COLUMNS, key_mode),
        counts=match_summary(
            hub, vendor, TRANSFER_RULES, COLUMNS, key_mode, late_is_failed=False
        ),
        settled=SETTLED_TRANSFER,
    )
