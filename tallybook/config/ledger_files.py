"""What the columns of ledger and statement files must hold, by service."""

from __future__ import annotations

from dataclasses import dataclass

from tallybook.errors import UnknownServiceError
from tallybook.functions.dates import MONTH_FIRST_LAYOUTS
from tallybook.operators.rejects import Check, amount, currency, date, serial


@dataclass(frozen=True)
class LedgerFiles:
    ledger: tuple[Check, ...]
    statement: tuple[Check, ...]


_REFUNDS = LedgerFiles(
    (amount("AMOUNT"), amount("COMM/SHARE"), amount("TDS"), date("DATE", MONTH_FIRST_LAYOUTS)),
    (
        amount("AMOUNT"),
        amount("NET COMMISSION"),
        amount("COMM"),
        amount("TDS"),
        date("DATE", MONTH_FIRST_LAYOUTS),
    ),
)
# Headers of the files, and the layouts of their dates.
LEDGER_FILES: dict[str, LedgerFiles] = {
    "RECHARGE": _REFUNDS,
    "DMT": _REFUNDS,
    "AEPS": LedgerFiles(
        (serial("SNO"), amount("AMOUNT")),
        (serial("SETTLED_ID"), amount("AMOUNT")),
    ),
    "MATM": LedgerFiles((currency("AMOUNT"),), (amount("AMOUNT"),)),
    "BBPS": LedgerFiles(
        (amount("DEBIT"), amount("CREDIT")),
        (amount("TRANSACTION AMOUNT(RS.)"),),
    ),
    "LIC": LedgerFiles((amount("DR"), amount("CR")), (amount("AMOUNT"),)),
    "PANUTI": LedgerFiles((amount("UTIITSL AMOUNT"),), (amount("RES AMOUNT"),)),
    "ABHIBUS": LedgerFiles(
        (date("BALANCE DATE", ("dd-MM-yyyy",)), amount("USED AMOUNT")),
        (
            date("BOOKED DATE", ("dd-MM-yyyy HH:mm",)),
            amount("TICKET AMOUNT"),
            amount("SERVICE TAX"),
            amount("COMM."),
            amount("COMM TDS"),
        ),
    ),
}


def ledger_files(service: str) -> LedgerFiles:
    if service not in LEDGER_FILES:
        raise UnknownServiceError(f"no ledger reconciliation for '{service}'")
    return LEDGER_FILES[service]
