"""Ticket-booking wallet report: per transaction the largest debit and credit and four flags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.config.hub_services import TICKET_WALLET_PATTERN
from tallybook.functions.dates import Day, in_days
from tallybook.operators.wallet import amounts_and_flags
from tallybook.plans.hub_extract import service_wallet
from tallybook.sources.tables import Tables


def ticket_wallet_report(tables: Tables, start: Day, end: Day) -> DataFrame:
    wallet = service_wallet(tables, TICKET_WALLET_PATTERN, (start, end))
    master = tables["MasterTransaction"].where(in_days("CreationTs", start, end))
    return amounts_and_flags(wallet, master)
