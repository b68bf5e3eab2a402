"""How each service's vendor file is read: canonical columns, dates, keys, statuses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tallybook.errors import UnknownServiceError
from tallybook.functions.dates import DAY_FIRST_LAYOUTS, MONTH_FIRST_LAYOUTS
from tallybook.functions.status import (
    FAILED,
    INITIATED,
    SUCCESS,
    TIMED_OUT,
    ContainsStatus,
    EqualsStatus,
    ExactStatus,
    KeepStatus,
    StatusRule,
)


@dataclass(frozen=True)
class VendorFile:
    columns: Mapping[str, str]
    required: tuple[str, ...]
    layouts: tuple[str, ...] = MONTH_FIRST_LAYOUTS
    alternate_columns: Mapping[str, str] | None = None
    # (first character, length) of the part of the key that is compared
    key_slice: tuple[int, int] | None = None
    # rows in which all of these are null carry no transaction
    any_of: tuple[str, ...] = ()
    status: StatusRule = field(default_factory=KeepStatus)
    # a further column added to the amount
    surcharge: str | None = None
    # inner runs of white space in keys are insignificant
    squeeze_key: bool = False


# Source column -> canonical column, required columns, date layouts,
# key slices and status words of the vendor files.
VENDOR_FILES: dict[str, VendorFile] = {
    "BBPS": VendorFile(
        columns={
            "Transaction Ref ID": "REFID",
            "Transaction Date": "VENDOR_DATE",
            "NPCI Transaction Desc": "VENDOR_STATUS",
            "Transaction Amount(RS.)": "VENDOR_AMOUNT",
        },
        required=("Transaction Ref ID",),
        layouts=("dd-MMM-yyyy HH:mm:ss",),
        status=ExactStatus(
            {
                "Successful": SUCCESS,
                "Failure": FAILED,
                "Transaction timed out": TIMED_OUT,
                "": FAILED,
            }
        ),
    ),
    "PASSPORT": VendorFile(
        columns={
            "Ref No": "REFID",
            "Txn Date": "VENDOR_DATE",
            "Status": "VENDOR_STATUS",
            "        Debit": "VENDOR_AMOUNT",
        },
        required=("Ref No",),
    ),
    "AEPS": VendorFile(
        columns={
            "SERIALNUMBER": "REFID",
            "DATE": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        alternate_columns={
            "SERIALNUMBER": "REFID",
            "ADDEDDATE": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        required=("SERIALNUMBER",),
    ),
    "RECHARGE": VendorFile(
        columns={
            "DATE": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        required=("REFID",),
    ),
    "DMT": VendorFile(
        columns={
            "DATE": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        required=("REFID",),
        status=ExactStatus({"Success": SUCCESS, "Refunded": FAILED, "Failed": FAILED}),
    ),
    "PANUTI": VendorFile(
        columns={
            "Reference No": "REFID",
            "trans Date": "VENDOR_DATE",
            "Payment Status": "VENDOR_STATUS",
            "Res Amount": "VENDOR_AMOUNT",
        },
        required=("Reference No",),
        status=ContainsStatus("refunded", found=FAILED, other=SUCCESS),
    ),
    "PANNSDL": VendorFile(
        columns={
            "Acknowledgment Number": "REFID",
            "Date": "VENDOR_DATE",
            "Status Of Application": "VENDOR_STATUS",
            "Appln Fee (`)": "VENDOR_AMOUNT",
        },
        required=("Acknowledgment Number",),
        layouts=DAY_FIRST_LAYOUTS,
        status=ContainsStatus("accepted", found=SUCCESS, other=FAILED),
    ),
    "MATM": VendorFile(
        columns={
            "RRN": "REFID",
            "Date": "VENDOR_DATE",
            "TRANSACTIONSTATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        required=("RRN",),
        any_of=("TID", "REFID", "DEVICE"),
        status=ContainsStatus("auth_success", found=SUCCESS, other=FAILED),
    ),
    "LIC": VendorFile(
        columns={
            "ORDERID": "REFID",
            "Date": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "AMOUNT": "VENDOR_AMOUNT",
        },
        required=("ORDERID",),
        any_of=("REFID", "IMWTID", "OPERATORID"),
    ),
    "ASTRO": VendorFile(
        columns={
            "Order ID": "REFID",
            "Date": "VENDOR_DATE",
            "Transaction Status": "VENDOR_STATUS",
            "Price": "VENDOR_AMOUNT",
        },
        required=("Order ID",),
        status=ExactStatus(
            {
                "Processed": SUCCESS,
                "Rolled Back": INITIATED,
                "Not Processed": FAILED,
            }
        ),
    ),
    "UPIQR": VendorFile(
        columns={
            "TRNSCTN_NMBR": "REFID",
            "CRTD_DATE": "VENDOR_DATE",
            "STATUS": "VENDOR_STATUS",
            "Settled_Amount": "VENDOR_AMOUNT",
        },
        required=("Unique_ID",),
        layouts=DAY_FIRST_LAYOUTS,
        status=EqualsStatus("authorised", found=SUCCESS, other=FAILED),
    ),
    "INSURANCE_OFFLINE": VendorFile(
        columns={
            "Policy No": "REFID",
            "Issued Date": "VENDOR_DATE",
            "Status": "VENDOR_STATUS",
            "Total Amount": "VENDOR_AMOUNT",
        },
        required=("Policy No",),
        key_slice=(1, 20),
    ),
    "ABHIBUS": VendorFile(
        columns={
            "Tkt. Number": "REFID",
            "Booked Date": "VENDOR_DATE",
            "Status": "VENDOR_STATUS",
            "Ticket Amount": "VENDOR_AMOUNT",
        },
        required=("Tkt. Number",),
        surcharge="Service Tax",
    ),
    "MOVETOBANK": VendorFile(
        columns={
            "Corporate Ref No": "REFID",
            "Transaction Status": "VENDOR_STATUS",
            "Creation Date": "VENDOR_DATE",
            "Transaction Amount": "VENDOR_AMOUNT",
        },
        required=("Corporate Ref No",),
        status=ExactStatus({"PROCESSED": SUCCESS, "REJECTED": FAILED}),
    ),
    "SULTANPURSCA": VendorFile(
        columns={"Application ID": "REFID", "Transaction Date": "VENDOR_DATE"},
        required=("Application ID",),
        layouts=("dd/MM/yyyy",),
    ),
    "CHITRAKOOT_SCA": VendorFile(
        columns={"Application ID": "REFID", "Transaction Date": "VENDOR_DATE"},
        required=("Application ID",),
        layouts=("dd/MM/yyyy",),
    ),
    "SULTANPUR_IS": VendorFile(
        columns={"Quota ID": "REFID", "Transaction Date": "VENDOR_DATE"},
        required=("Quota ID",),
        key_slice=(2, 10),
    ),
    "CHITRAKOOT_IS": VendorFile(
        columns={"Quota ID": "REFID", "Transaction Date": "VENDOR_DATE"},
        required=("Quota ID",),
        key_slice=(2, 10),
    ),
    "MANUAL_TB": VendorFile(
        columns={
            "Description": "REFID",
            "Status": "VENDOR_STATUS",
            "Txn / Value Date": "VENDOR_DATE",
        },
        required=("Description",),
        squeeze_key=True,
    ),
    "IMPS": VendorFile(
        columns={
            "UTR Number": "REFID",
            "Status": "VENDOR_STATUS",
            "Transaction Date": "VENDOR_DATE",
            "Amount": "VENDOR_AMOUNT",
        },
        required=("UTR Number",),
        status=KeepStatus(strip=False),
    ),
    "BBPS_DATA_ENTRY": VendorFile(
        columns={
            "NPCI Ref NO": "HeadReferenceId",
            "Transaction Ref ID": "TxnRefId",
            "NPCI Transaction Desc": "TransactionStatusType",
        },
        required=("NPCI Ref NO",),
    ),
}


def vendor_file(service: str) -> VendorFile:
    if service not in VENDOR_FILES:
        raise UnknownServiceError(f"no vendor file is configured for '{service}'")
    return VENDOR_FILES[service]
