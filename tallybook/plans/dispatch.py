"""One entry point per kind of request: a service name and its inputs in, a result out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.errors import TallyError
from tallybook.functions.dates import Day
from tallybook.plans import bill_entry, qr_recon, transfer_recon
from tallybook.plans.hub_recon import reconcile_service
from tallybook.plans.requests_recon import REQUEST_SERVICES, reconcile_requests
from tallybook.plans.result import Result
from tallybook.plans.vendor_input import has_rows_in_window, prepare_vendor
from tallybook.plans.wallet_report import ticket_wallet_report
from tallybook.sources.tables import Tables

TICKET_SERVICE = "IRCTC"


class EmptyWindowError(TallyError):
    """The vendor file has no row in the requested window."""


def reconcile(
    service: str,
    vendor_file: DataFrame | None,
    tables: Tables,
    start: Day,
    end: Day,
    transaction_type: str | None = None,
    check_window: bool = True,
    stage: bool = False,
) -> Result | DataFrame:
    """Run the reconciliation of ``service``; the two services that only report give a frame.

    ``check_window`` runs one short job that fails early on a file without any
    row in the window. The file is then reconciled as a whole. ``stage`` writes
    intermediate sides that several buckets read to the cluster's shared folder.
    """
    if service == TICKET_SERVICE:
        return ticket_wallet_report(tables, start, end)
    if service == bill_entry.SERVICE:
        return bill_entry.bill_entries(vendor_file, tables, start, end)
    if check_window:
        prepared = prepare_vendor(vendor_file, service, transaction_type)
        if not has_rows_in_window(prepared, start, end):
            raise EmptyWindowError(f"{service}: no vendor row from {start} to {end}")
    if service == qr_recon.SERVICE:
        return qr_recon.reconcile_qr(vendor_file, tables, start, end, stage)
    if service == transfer_recon.SERVICE:
        return transfer_recon.reconcile_transfers(
            vendor_file, tables, start, end, stage=stage
        )
    if service in REQUEST_SERVICES:
        return reconcile_requests(service, vendor_file, tables, start, end, stage)
    return reconcile_service(
        service, vendor_file, tables, start, end, transaction_type, stage=stage
    )
