"""Vendor bill payments completed with the bill-fetch record and the sub-transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import BILL_ENTRY_CODES
from tallybook.functions.dates import Day, in_days, micros_text
from tallybook.functions.labels import label
from tallybook.functions.text import like_text
from tallybook.operators.columns import select_existing
from tallybook.operators.match import exact, inner_match
from tallybook.plans.vendor_input import canonical
from tallybook.sources.tables import Tables

SERVICE = "BBPS_DATA_ENTRY"

# Result columns, in order. Request and response bodies are passed on unread.
FETCH_COLUMNS = (
    "BBPS_BillerDetailId",
    "CustomerMobile",
    "Amount",
    "CreationTs",
    "HeadReferenceId_db",
    "CustomerData",
    "CustomerName",
    "Request",
    "Response",
    "CreationUserId",
    "EncryptedRequest",
    "EncryptedResponse",
)


def bill_entries(
    vendor_file: DataFrame, tables: Tables, start: Day, end: Day
) -> DataFrame:
    vendor = canonical(vendor_file, SERVICE).select(
        "TxnRefId",
        "HeadReferenceId",
        label("TransactionStatusType", BILL_ENTRY_CODES).alias("TransactionStatusType"),
    )
    fetched = (
        tables["BBPS_BillFetch"]
        .where(in_days("CreationTs", start, end))
        .withColumnsRenamed(
            {
                "Id": "BBPS_BillFetchId",
                "BillAmount": "Amount",
                "HeadReferenceId": "HeadReferenceId_db",
            }
        )
        .withColumn("CreationTs", micros_text("CreationTs"))
    )
    fetched = select_existing(fetched, ["BBPS_BillFetchId", *FETCH_COLUMNS])
    subs = (
        tables["MasterSubTransaction"]
        .where(
            in_days("CreationTs", start, end) & like_text("TransRefNumVendorSub", "%KM%")
        )
        .select(F.col("Id").alias("MST_ID"), F.col("TransRefNumVendorSub").alias("VEND_ID"))
    )
    with_bill = inner_match(
        vendor, fetched, "HeadReferenceId", "HeadReferenceId_db", exact
    )
    return inner_match(with_bill, subs, "TxnRefId", "VEND_ID", exact)
