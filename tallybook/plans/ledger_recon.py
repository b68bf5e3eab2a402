"""Vendor ledger against vendor statement, by service."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame

from tallybook.config.ledger_files import ledger_files
from tallybook.errors import UnknownServiceError
from tallybook.operators.rejects import accepted, rejected
from tallybook.plans.ledger_amounts import reconcile_amounts, reconcile_references
from tallybook.plans.ledger_bills import reconcile_bills
from tallybook.plans.ledger_commission import reconcile_commission
from tallybook.plans.ledger_daily import reconcile_daily
from tallybook.plans.ledger_refunds import reconcile_refunds
from tallybook.plans.ledger_settlement import reconcile_settlement
from tallybook.plans.result import Result

# Which reconciliation serves which service.
LEDGER_PLANS: dict[str, Callable[[DataFrame, DataFrame], Result]] = {
    "RECHARGE": reconcile_refunds,
    "DMT": lambda led, stm: reconcile_refunds(led, stm, refund_in_column=True),
    "AEPS": reconcile_settlement,
    "MATM": reconcile_amounts,
    "BBPS": reconcile_bills,
    "LIC": reconcile_commission,
    "PANUTI": reconcile_references,
    "ABHIBUS": lambda led, stm: reconcile_daily(led, stm)[0],
}


# The plans that can keep an intermediate result in the shared folder.
STAGED_PLANS: dict[str, Callable[[DataFrame, DataFrame], Result]] = {
    "AEPS": lambda led, stm: reconcile_settlement(led, stm, stage=True),
}


def reconcile_ledger(
    service: str, ledger: DataFrame, statement: DataFrame, stage: bool = False
) -> Result:
    """Buckets and counts for one service's pair of files, and the rows with unreadable values.

    Lines that do not fit their file's layout (see ``read_csv``) take no part. ``stage`` lets a plan keep rows
    that it uses several times in the shared folder.
    """
    if service not in LEDGER_PLANS:
        raise UnknownServiceError(f"no ledger reconciliation for '{service}'")
    files = ledger_files(service)
    plan = (STAGED_PLANS if stage else {}).get(service, LEDGER_PLANS[service])
    found = plan(accepted(ledger), accepted(statement))
    rejects = rejected(ledger, "ledger", files.ledger).unionByName(
        rejected(statement, "statement", files.statement)
    )
    return replace(found, rejects=rejects)
