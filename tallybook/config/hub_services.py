"""Where each service's internal transactions live and how their codes read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tallybook.errors import UnknownServiceError
from tallybook.functions.status import INITIATED
from tallybook.operators.wallet import WALLET_FLAGS, WALLET_FLAGS_AEPS, Flags


@dataclass(frozen=True)
class HubService:
    """One internal extract.

    Column names refer to the service's detail table unless stated otherwise.
    """

    detail: str
    key: str
    status: str
    codes: Mapping[int, str]
    wallet_pattern: str
    # spellings of older results, used on request
    legacy_codes: Mapping[int, str] = field(default_factory=dict)
    amount: str | None = "Amount"
    # amount taken from another table: (table, detail column, its key, its amount)
    amount_from: tuple[str, str, str, str] | None = None
    # amount taken from the sub-transaction instead of the detail table
    amount_in_sub: str | None = None
    window: str = "CreationTs"
    # date shown, if not the one the window is applied to
    shown_date: str | None = None
    # date shown is the master transaction's
    shown_master_date: bool = False
    # key kept in another table: (table, detail column, its key, its reference)
    key_from: tuple[str, str, str, str] | None = None
    # extra label column: (table, detail column, its key, its column, output name)
    dimension: tuple[str, str, str, str, str] | None = None
    # extra presence flag: (table, detail column, its column, output name)
    presence: tuple[str, str, str, str] | None = None
    # detail column that the transaction type is compared with, and its values
    mode: str | None = None
    modes: tuple[str, ...] = ()
    require_key: bool = False
    # the detail table leads: its rows stay even without a master transaction
    detail_leads: bool = False
    strip_key: bool = False
    tenant_ledger: bool = True
    # wallet entries of earlier dates are looked up where the window has none
    backfill: bool = False
    flags: Flags = field(default_factory=lambda: WALLET_FLAGS)


# Detail tables, key, status and amount columns, status codes and
# wallet service patterns.
HUB_SERVICES: dict[str, HubService] = {
    "RECHARGE": HubService(
        detail="PsRechargeTransaction",
        key="requestID",
        status="rechargeStatus",
        codes={
            0: "initiated",
            1: "success",
            2: "pending",
            3: "failed",
            4: "instant failed",
        },
        wallet_pattern="%All - Recharge%",
    ),
    "BBPS": HubService(
        detail="BBPS_BillPay",
        key="TxnRefId",
        status="TransactionStatusType",
        codes={
            0: "unknown",
            1: "success",
            2: "failed",
            3: "inprogress",
            4: "partial success",
        },
        legacy_codes={4: "partialsuccuess"},
        wallet_pattern="%BillPayment%",
        dimension=(
            "BBPS_BillerDetail",
            "BBPS_BillerDetailId",
            "id",
            "CategoryName",
            "BBPS_CATEGORY",
        ),
        presence=(
            "BBPS_BillFetch",
            "HeadReferenceId",
            "HeadReferenceId",
            "BILL_FETCH_STATUS",
        ),
    ),
    "PANUTI": HubService(
        detail="UTIITSLTTransaction",
        key="ApplicationNumber",
        status="TransactionStatusType",
        codes={0: "failed", 1: "success"},
        wallet_pattern="%PAN-UTI%",
        detail_leads=True,
        amount="TransactionAmount",
    ),
    "DMT": HubService(
        detail="PaySprint_Transaction",
        key="VendorReferenceId",
        status="PaySprintTransStatus",
        codes={
            0: "failedandrefunded",
            1: "success",
            2: "inprocess",
            3: "sendtobank",
            4: "onhold",
            5: "failed",
            111: "tenantwalletinit",
        },
        wallet_pattern="%Money Transfer%",
    ),
    "PANNSDL": HubService(
        detail="PanInTransaction",
        key="AcknowledgeNo",
        status="ApplicationStatus",
        codes={
            0: "None",
            1: "New",
            2: "Acknowledged",
            3: "Rejected",
            4: "Uploaded",
            5: "Processed",
            6: "Reupload",
            7: "Alloted",
            8: "Objection",
            9: "MoveToNew",
        },
        wallet_pattern="%Pan Internal%",
        detail_leads=True,
        window="ApplicationStatusTs",
        shown_date="CreationTs",
        require_key=True,
    ),
    "PASSPORT": HubService(
        detail="PassportIn",
        key="BankReferenceNumber",
        status="PassportInStatusType",
        codes={
            0: "unknown",
            1: "NewRequest",
            2: "CallMade",
            3: "AppointmentFixed",
            4: "ApplicationClosed",
            5: "ApplicationRejected",
            6: "ReAppointment",
        },
        wallet_pattern="%Passport%",
        detail_leads=True,
        window="BankReferenceTs",
        backfill=True,
    ),
    "LIC": HubService(
        detail="LicPremiumTransaction",
        key="OrderId",
        status="BillPayStatus",
        codes={0: "initiated", 1: "success", 2: "failed"},
        wallet_pattern="%LIC%",
        detail_leads=True,
        amount=None,
        amount_from=("LicPremiumBillFetch", "BillFetchId", "id", "Billedamount"),
    ),
    "ASTRO": HubService(
        detail="AstroTransaction",
        key="OrderId",
        status="AstroTransactionStatus",
        codes={0: "initiated", 1: "unknown", 2: "success"},
        wallet_pattern="%Astrology%",
        amount=None,
        amount_in_sub="TranAmountTotal",
    ),
    "INSURANCE_OFFLINE": HubService(
        detail="NewIndiaInsuranceTransaction",
        key="PolicyNumber",
        status="InsuranceStatusType",
        codes={
            0: "unknown",
            1: "NewRequest",
            2: "InProcess",
            3: "Completed",
            4: "Rejected",
        },
        wallet_pattern="%Insurance%",
        strip_key=True,
    ),
    "ABHIBUS": HubService(
        detail="AbhiBus_TicketDetail",
        key="PnrNumber",
        status="TicketStatusType",
        codes={
            0: "initiated",
            2: "success",
            3: "failed",
            4: "failed and refunded",
        },
        legacy_codes={0: "initated"},
        wallet_pattern="%BusBooking%",
        amount="TotalAmount",
    ),
    "MOVETOBANK": HubService(
        detail="AxisMtbTransaction",
        key="requestUUID",
        status="TransactionStatus",
        codes={
            0: "unknown",
            1: "pending",
            2: "failed",
            3: "success",
            4: "failed and refunded",
        },
        wallet_pattern="%MoveToBank%",
        amount="TxnAmount",
        shown_master_date=True,
    ),
    "AEPS": HubService(
        detail="PsAepsTransaction",
        key="ReferenceNo",
        key_from=("PsAepsRequest", "RequestId", "id", "ReferenceNo"),
        status="TransStatus",
        codes={
            0: "failed",
            1: "success",
            2: "timeout",
            3: "inprocess",
            254: "failed",
            255: "initiated",
        },
        wallet_pattern="%AEPS%",
        mode="TransMode",
        modes=("2", "3"),
        tenant_ledger=False,
        flags=WALLET_FLAGS_AEPS,
    ),
    "MATM": HubService(
        detail="ImWalletMatmTransaction",
        key="Rrn",
        status="TransStatusType",
        codes={0: "unknown", 1: "failed", 2: "success"},
        wallet_pattern="%M-ATM%",
    ),
}

# Status names of the second system that may know a missing application,
# of the bank-transfer service and of manual top-ups.
ELSEWHERE_CODES = {"1": "success", "2": INITIATED, "3": "failed"}
TRANSFER_CODES = {"1": "success", "0": "failed"}
TOPUP_CODES = {
    0: "unknown",
    1: "New Request",
    2: "Yet To Credit",
    3: "Approved by Accountant",
    4: "Approved by Accountant Special",
    5: "Approved by Admin",
    6: "Approved by Admin Special",
    7: "Cancel",
}
BILL_ENTRY_CODES = {"Successful": "1", "Transaction timed out": "2"}

# Wallet service patterns of the services without a common extract.
TICKET_WALLET_PATTERN = "%IRCTC%"
QR_WALLET_PATTERN = "%UPI%"


def hub_service(service: str) -> HubService:
    if service not in HUB_SERVICES:
        raise UnknownServiceError(f"no hub extract is configured for '{service}'")
    return HUB_SERVICES[service]
