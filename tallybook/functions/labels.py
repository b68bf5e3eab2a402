"""Codes to labels and yes/no flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col

YES, NO = "Yes", "No"

# Tenant names by id.
TENANTS = {1: "INET-CSC", 2: "ITI-ESEVA", 3: "UPCB"}

# Hub status names by code; the payment-QR service has its own codes.
HUB_STATUS = {
    0: "initiated",
    1: "success",
    2: "failed",
    3: "inprogress",
    4: "partial success",
}
QR_STATUS = {0: "success", 5: "inprogress", 7: "failed", 255: "initiated"}

# Centre type names by code.
CENTRE_TYPES = {1: "Jenseva Kendra", 2: "Panchayat Sahayak"}
CENTRE_OTHER = "EBO"


def label(c: ColumnOrName, names: Mapping[object, str]) -> Column:
    """Name of a code; a code without a name is kept as its own text."""
    col = as_col(c)
    out = None
    for code, name in names.items():
        out = (F if out is None else out).when(col == F.lit(code), F.lit(name))
    text = col.cast("string")
    return text if out is None else out.otherwise(text)


def label_or(c: ColumnOrName, names: Mapping[object, str], other: str) -> Column:
    """Name of a code, ``other`` for any unlisted or null code."""
    col = as_col(c)
    out = None
    for code, name in names.items():
        out = (F if out is None else out).when(col == F.lit(code), F.lit(name))
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


def tenant_name(c: ColumnOrName) -> Column:
    return label(c, TENANTS)


def centre_type(c: ColumnOrName) -> Column:
    return label_or(c, CENTRE_TYPES, CENTRE_OTHER)


def yes_no(condition: Column) -> Column:
    """``Yes`` where true, ``No`` where false or null."""
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def first_present(*cs: ColumnOrName) -> Column:
    return F.coalesce(*[as_col(c) for c in cs])


def credit_origin(vendor_ref: ColumnOrName, hub_ref: ColumnOrName) -> Column:
    """How a wallet credit came about, told from which reference it carries."""
    return (
        F.when(as_col(vendor_ref).isNotNull(), F.lit("AUTO_CREDIT"))
        .when(as_col(hub_ref).isNotNull(), F.lit("MANUAL_REFUND"))
        .otherwise(F.lit("UNKNOWN"))
    )
