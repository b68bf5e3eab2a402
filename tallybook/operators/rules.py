"""Outcome buckets: rule tables and the single CASE expression built from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName
from tallybook.functions.status import FAILED, SUCCESS, TIMED_OUT, lower_status

MATCHED, MISMATCHED = "MATCHED", "MISMATCHED"
NOT_IN_VENDOR, NOT_IN_PORTAL = "NOT_IN_VENDOR", "NOT_IN_PORTAL"
MATCHED_ELSEWHERE = "MATCHED_IN_ITI"
OTHER_DATE = "IN_PORTAL_DIFF_DATE"
# Not part of the fixed values: rows that no rule covers are kept, under this name.
UNCLASSIFIED = "UNCLASSIFIED"


@dataclass(frozen=True)
class Rule:
    """A bucket and the lower-case statuses that lead to it."""

    category: str
    vendor: tuple[str, ...]
    hub: tuple[str, ...]
    ledger: str | None = None

    def vendor_test(self, status: Column) -> Column:
        return F.coalesce(status.isin(*self.vendor), F.lit(False))

    def hub_test(self, status: Column, ledger: Column | None) -> Column:
        test = status.isin(*self.hub)
        if self.ledger is not None:
            test = test & (ledger == self.ledger)
        return F.coalesce(test, F.lit(False))


_OK = (SUCCESS,)
_FAIL = (FAILED,)
_FAIL_OR_LATE = (FAILED, TIMED_OUT)
_OPEN = ("initiated", "inprogress", "pending")
_OPEN_QR = ("initiated", "inprogress")

# Bucket names and conditions, vendor status x hub status x ledger flag.
LEDGER_RULES = (
    Rule("VEND_IHUB_SUC-NIL", _OK, _OK, "no"),
    Rule("VEND_FAIL_IHUB_SUC-NIL", _FAIL, _OK, "no"),
    Rule("VEND_SUC_IHUB_FAIL-NIL", _OK, _FAIL, "no"),
    Rule("IHUB_FAIL_VEND_FAIL-NIL", _FAIL_OR_LATE, _FAIL, "no"),
    Rule("IHUB_INT_VEND_SUC-NIL", _OK, _OPEN, "no"),
    Rule("VEND_FAIL_IHUB_INT-NIL", _FAIL_OR_LATE, _OPEN, "no"),
    Rule("VEND_IHUB_SUC", _OK, _OK, "yes"),
    Rule("VEND_IHUB_FAIL", _FAIL_OR_LATE, _FAIL, "yes"),
    Rule("VEND_FAIL_IHUB_SUC", _FAIL_OR_LATE, _OK, "yes"),
    Rule("VEND_SUC_IHUB_FAIL", _OK, _FAIL, "yes"),
    Rule("IHUB_INT_VEND_SUC", _OK, _OPEN, "yes"),
    Rule("VEND_FAIL_IHUB_INT", _FAIL_OR_LATE, _OPEN, "yes"),
)

# The bank-transfer service, without a ledger flag.
TRANSFER_RULES = (
    Rule("VEND_IHUB_SUC", _OK, _OK),
    Rule("VEND_FAIL_IHUB_SUC", _FAIL, _OK),
    Rule("VEND_SUC_IHUB_FAIL", _OK, _FAIL),
    Rule("IHUB_FAIL_VEND_FAIL", _FAIL_OR_LATE, _FAIL),
    Rule("IHUB_INT_VEND_SUC", _OK, _OPEN),
    Rule("VEND_FAIL_IHUB_INT", _FAIL_OR_LATE, _OPEN),
)

# The payment-QR service, without a ledger flag.
QR_RULES = (
    Rule("VEND_IHUB_SUC", _OK, _OK),
    Rule("VEND_IHUB_FAIL", _FAIL, _FAIL),
    Rule("VEND_FAIL_IHUB_SUC", _FAIL, _OK),
    Rule("VEND_SUC_IHUB_FAIL", _OK, _FAIL),
    Rule("IHUB_INT_VEND_SUC", _OK, _OPEN_QR),
    Rule("VEND_FAIL_IHUB_INT", _FAIL, _OPEN_QR),
)

# Buckets that are no exceptions, hence absent from the combined report.
SETTLED = ("VEND_IHUB_SUC", "VEND_IHUB_FAIL")
SETTLED_TRANSFER = ("VEND_IHUB_SUC", "IHUB_FAIL_VEND_FAIL")


def classify(
    rules: Sequence[Rule],
    vendor_status: ColumnOrName,
    hub_status: ColumnOrName,
    ledger: ColumnOrName | None = None,
    other: str = UNCLASSIFIED,
) -> Column:
    """Bucket of a matched row. The rules exclude each other, so their order is irrelevant."""
    v, h = lower_status(vendor_status), lower_status(hub_status)
    l = None if ledger is None else lower_status(ledger)
    out = None
    for rule in rules:
        test = rule.vendor_test(v) & rule.hub_test(h, l)
        out = (F if out is None else out).when(test, F.lit(rule.category))
    return out.otherwise(F.lit(other))


def statuses_differ(a: ColumnOrName, b: ColumnOrName) -> Column:
    """True where two statuses differ in any-case comparison, or one is null."""
    return ~F.coalesce(lower_status(a) == lower_status(b), F.lit(False))
