"""From a raw vendor file to canonical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config.vendor_files import VendorFile, vendor_file
from tallybook.errors import UnknownServiceError
from tallybook.functions._cols import as_col
from tallybook.functions.dates import Day, in_days, parse_date
from tallybook.functions.numbers import is_bad_number, to_number
from tallybook.functions.text import char_slice, squeeze
from tallybook.operators.columns import rename_existing
from tallybook.operators.filters import drop_all_null
from tallybook.sources.files import as_text, require_columns
from tallybook.sources.tables import is_empty_window

MINI_STATEMENT = "3"


def canonical(
    df: DataFrame, service: str, transaction_type: str | None = None
) -> DataFrame:
    """All columns as text under their canonical names; raises on a wrong file."""
    spec = vendor_file(service)
    columns = spec.columns
    if transaction_type == MINI_STATEMENT:
        if spec.alternate_columns is None:
            raise UnknownServiceError(
                f"{service} has no column map for transaction type {transaction_type}"
            )
        columns = spec.alternate_columns
    require_columns(df, spec.required, f"{service} file")
    return rename_existing(as_text(df), columns)


def _amount(spec: VendorFile):
    amount = to_number("VENDOR_AMOUNT")
    return amount if spec.surcharge is None else amount + to_number(spec.surcharge)


def prepare_vendor(
    df: DataFrame,
    service: str,
    transaction_type: str | None = None,
    window: tuple[Day, Day] | None = None,
) -> DataFrame:
    """Vendor rows ready for matching.

    Rows outside the dates of interest are kept, since a late vendor row may
    settle an earlier hub row; pass ``window`` to drop them.
    """
    spec = vendor_file(service)
    out = canonical(df, service, transaction_type)
    if spec.key_slice:
        out = out.withColumn("REFID", char_slice("REFID", *spec.key_slice))
    if spec.squeeze_key:
        out = out.withColumn("REFID", squeeze("REFID"))
    if spec.any_of:
        out = drop_all_null(out, spec.any_of)
    changes = {}
    if "VENDOR_DATE" in out.columns:
        changes["VENDOR_DATE"] = parse_date("VENDOR_DATE", spec.layouts)
    if "VENDOR_STATUS" in out.columns:
        changes["VENDOR_STATUS"] = spec.status.apply("VENDOR_STATUS")
    if "VENDOR_AMOUNT" in out.columns:
        changes["VENDOR_AMOUNT"] = _amount(spec)
    out = out.withColumns(changes)
    return out.where(in_days("VENDOR_DATE", *window)) if window else out


def vendor_rejects(
    df: DataFrame, service: str, transaction_type: str | None = None
) -> DataFrame:
    """Rows whose amount or date is present but cannot be read, with the reason."""
    spec = vendor_file(service)
    raw = canonical(df, service, transaction_type)
    reasons = []
    if "VENDOR_AMOUNT" in raw.columns:
        reasons.append(F.when(is_bad_number("VENDOR_AMOUNT"), F.lit("amount")))
    if "VENDOR_DATE" in raw.columns:
        unread = parse_date("VENDOR_DATE", spec.layouts).isNull()
        given = as_col("VENDOR_DATE").isNotNull()
        reasons.append(F.when(given & unread, F.lit("date")))
    if not reasons:
        return raw.withColumn("REASON", F.lit(None).cast("string")).where(F.lit(False))
    reason = F.concat_ws(",", *reasons)
    return raw.withColumn("REASON", reason).where(F.col("REASON") != "")


def has_rows_in_window(prepared: DataFrame, start: Day, end: Day) -> bool:
    """The guard run before a reconciliation: at least one vendor row in the window."""
    return not is_empty_window(prepared, in_days("VENDOR_DATE", start, end))
