"""Payment-QR service: own status codes, two wallet links, bank references that lag behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import QR_WALLET_PATTERN
from tallybook.functions.dates import Day, in_days, in_lookahead
from tallybook.functions.labels import (
    QR_STATUS,
    credit_origin,
    first_present,
    label,
    tenant_name,
    yes_no,
)
from tallybook.functions.text import like_text, null_words_to_null
from tallybook.operators.columns import select_existing, tagged, union_aligned
from tallybook.operators.filters import reference_not_updated
from tallybook.operators.latest import keep_first
from tallybook.operators.match import exact, inner_match, missing_from, own_shuffle
from tallybook.operators.rules import (
    NOT_IN_PORTAL,
    NOT_IN_VENDOR,
    QR_RULES,
    SETTLED,
    classify,
)
from tallybook.operators.summary import count_frame, pair_counts
from tallybook.operators.wallet import TOPUP_CREDIT
from tallybook.plans.result import Result
from tallybook.plans.vendor_input import prepare_vendor
from tallybook.sources.staging import staged
from tallybook.sources.tables import Tables

SERVICE = "UPIQR"
BANK_REF_NOT_UPDATED = "BANK_REF_NOT_UPDATED"
# Not part of the fixed values: payments that give way to another one of the same bank reference.
SHARED_BANK_REF = "SHARED_BANK_REF"
# Payments without an own id that give way or cannot be told apart, and payments that the vendor knows by
# our own id under another bank reference.
GAVE_WAY, OWN_ID_ONLY = "GAVE_WAY", "OWN_ID_ONLY"
_OWN = "__own"

# Result columns, in order.
RESULT_COLUMNS = (
    "CATEGORY",
    "VENDOR_DATE",
    "TENANT_ID",
    "VENDOR_REFERENCE",
    "REFID",
    "REFERENCE_NO",
    "IHUB_USERNAME",
    "TRANS_MODE",
    "HUB_AMOUNT",
    "VENDOR_AMOUNT",
    "SERVICE_DATE",
    "VENDOR_STATUS",
    "IHUB_MASTER_STATUS",
    "UPIQR_STATUS",
    "EBO_WALLET_CREDIT",
    "TRANSACTION_TYPE",
)


def qr_transactions(tables: Tables, start: Day, end: Day) -> DataFrame:
    """Payments and their sessions, both created in the window."""
    sessions = (
        tables["WhiteLabelSession"]
        .where(in_days("CreationTs", start, end))
        .select(
            F.col("Id").alias("SESSION_ID"),
            tenant_name("TenantDetailId").alias("TENANT_ID"),
            F.col("EboUserName").alias("IHUB_USERNAME"),
        )
    )
    payments = tables["AxisEpTransaction"].where(
        in_days("CreationTs", start, end)
    )
    return payments.join(
        sessions, F.col("WhiteLabelSessionId") == F.col("SESSION_ID")
    ).select(
        null_words_to_null("ReferenceNo").alias("REFERENCE_NO"),
        null_words_to_null("BankReferenceNo").alias("VENDOR_REFERENCE"),
        label("TransStatus", QR_STATUS).alias("IHUB_MASTER_STATUS"),
        F.col("TransRemarks").alias("UPIQR_STATUS"),
        F.col("CreationTs").cast("date").alias("SERVICE_DATE"),
        "TENANT_ID",
        "IHUB_USERNAME",
        F.col("Amount").alias("HUB_AMOUNT"),
        F.col("RE2").alias("TRANS_MODE"),
    )


def wallet_credits(tables: Tables, start: Day, end: Day) -> DataFrame:
    """Wallet credits per vendor reference, hub reference and service name."""
    entries = tables["EboWalletTransaction"].where(
        in_lookahead("CreationTs", start, end, closed=False)
        & like_text("ServiceName", QR_WALLET_PATTERN)
    )
    return (
        entries.groupBy("VendorReferenceId", "IHubReferenceId", "ServiceName")
        .agg(
            yes_no(F.bool_or(F.col("Description").isin(*TOPUP_CREDIT))).alias(
                "EBO_WALLET_CREDIT"
            )
        )
        .withColumn(
            "UNIQUE_REFERENCE",
            null_words_to_null(first_present("VendorReferenceId", "IHubReferenceId")),
        )
        .withColumn(
            "TRANSACTION_TYPE", credit_origin("VendorReferenceId", "IHubReferenceId")
        )
    )


def _keep_per_reference(rows: DataFrame, parity: bool, *order: Column | str) -> DataFrame:
    """The first row of each bank reference; rows without one are told apart by our own.

    ``parity`` treats all rows without a bank reference as one, which loses all but
    one of them, for comparison with tools that do so.
    """
    own = F.when(F.col("VENDOR_REFERENCE").isNull() & F.lit(not parity), F.col("REFERENCE_NO"))
    return keep_first(rows.withColumn(_OWN, own), ["VENDOR_REFERENCE", _OWN], *order).drop(_OWN)


def _credit_branch(
    payments: DataFrame, credits: DataFrame, key: str, origin: str
) -> DataFrame:
    # Both sides are cut to one row per key before the join; doing so after it
    # would give the same rows but could first multiply a hot key.
    one_credit = keep_first(
        credits.where(
            (F.col("TRANSACTION_TYPE") == origin) & F.col("UNIQUE_REFERENCE").isNotNull()
        ),
        "UNIQUE_REFERENCE",
        "VendorReferenceId",
        "IHubReferenceId",
        "ServiceName",
    )
    joined = payments.join(one_credit, F.col(key) == F.col("UNIQUE_REFERENCE"), "left")
    return joined.select(
        *[F.col(c) for c in payments.columns],
        "EBO_WALLET_CREDIT",
        "TRANSACTION_TYPE",
        F.coalesce("ServiceName", F.lit(SERVICE)).alias("SERVICE_NAME"),
        F.lit(origin).alias("MERGE_TYPE"),
    )


def with_wallet_credit(
    hub: DataFrame, credits: DataFrame, parity: bool = False
) -> DataFrame:
    """One row per bank reference, with its wallet credit by whichever link finds one.

    Payments without a bank reference have one row each, see ``_keep_per_reference``.

    A row with wallet data wins over one without; then the automatic link over
    the manual one; then the smaller own reference.
    """
    order = ("REFERENCE_NO", "VENDOR_REFERENCE")
    by_bank = _keep_per_reference(hub, parity, *order)
    by_own = keep_first(hub, "REFERENCE_NO", *order)
    both = _credit_branch(by_bank, credits, "VENDOR_REFERENCE", "AUTO_CREDIT").unionByName(
        _credit_branch(by_own, credits, "REFERENCE_NO", "MANUAL_REFUND")
    )
    return keep_best_credit(both, parity)


def keep_best_credit(rows: DataFrame, parity: bool = False) -> DataFrame:
    nothing = F.col("TRANSACTION_TYPE").isNull() & F.col("EBO_WALLET_CREDIT").isNull()
    return _keep_per_reference(rows, parity, nothing, "MERGE_TYPE", "REFERENCE_NO")


def shared_bank_ref(hub: DataFrame, enriched: DataFrame) -> DataFrame:
    """Payments that another payment of the same bank reference stands for in ``enriched``."""
    known = hub.where(
        F.col("VENDOR_REFERENCE").isNotNull() & F.col("REFERENCE_NO").isNotNull()
    )
    return missing_from(known, enriched, "REFERENCE_NO", "REFERENCE_NO", exact)


def bank_ref_missing(hub: DataFrame, vendor: DataFrame) -> DataFrame:
    """Payments the vendor knows by our own id, while the hub still lacks the bank's reference."""
    waiting = hub.where(reference_not_updated("VENDOR_REFERENCE", "REFERENCE_NO"))
    return inner_match(waiting, vendor, "REFERENCE_NO", "Unique_ID", exact)


def qr_buckets(enriched: DataFrame, hub: DataFrame, vendor: DataFrame) -> DataFrame:
    # grouped by the same reference: without a shuffle of its own a hot REFID could not be split
    matched = inner_match(
        own_shuffle(enriched, "VENDOR_REFERENCE"), vendor, "VENDOR_REFERENCE", "REFID", exact
    )
    matched = matched.withColumn(
        "CATEGORY", classify(QR_RULES, "VENDOR_STATUS", "IHUB_MASTER_STATUS")
    )
    hub_only = missing_from(enriched, vendor, "REFERENCE_NO", "Unique_ID", exact)
    vendor_only = missing_from(vendor, hub, "Unique_ID", "REFERENCE_NO", exact)
    parts = (
        matched,
        tagged(hub_only, NOT_IN_VENDOR),
        tagged(vendor_only.withColumnRenamed("Unique_ID", "REFERENCE_NO"), NOT_IN_PORTAL),
        tagged(bank_ref_missing(hub, vendor), BANK_REF_NOT_UPDATED),
        tagged(shared_bank_ref(hub, enriched), SHARED_BANK_REF),
    )
    return select_existing(
        union_aligned(*[select_existing(p, RESULT_COLUMNS) for p in parts]),
        RESULT_COLUMNS,
    )


def found_by_own_id_only(enriched: DataFrame, vendor: DataFrame) -> DataFrame:
    """Payments with their vendor rows, where the own ids agree and the vendor lacks the bank's reference."""
    other = enriched.where(
        F.col("REFERENCE_NO").isNotNull() & ~reference_not_updated("VENDOR_REFERENCE", "REFERENCE_NO")
    )
    unmatched = missing_from(other, vendor, "VENDOR_REFERENCE", "REFID", exact)
    return inner_match(unmatched, vendor, "REFERENCE_NO", "Unique_ID", exact)


def unplaced_payments(enriched: DataFrame, hub: DataFrame, vendor: DataFrame) -> DataFrame:
    """Payments that ``qr_buckets`` has no row for.

    A difference of multisets, which needs no row numbers: of equal payments, as many are left as are
    neither in ``enriched`` nor listed as sharing a bank reference.
    """
    shown = enriched.select(hub.columns).unionByName(shared_bank_ref(hub, enriched).select(hub.columns))
    parts = (
        tagged(hub.exceptAll(shown), GAVE_WAY),
        tagged(found_by_own_id_only(enriched, vendor), OWN_ID_ONLY),
    )
    return select_existing(
        union_aligned(*[select_existing(p, RESULT_COLUMNS) for p in parts]), RESULT_COLUMNS
    )


def qr_counts(enriched: DataFrame, vendor: DataFrame) -> DataFrame:
    """Counts compare the bank's own remark, not the hub status, with the vendor status."""
    own, theirs = F.lower("UPIQR_STATUS"), F.lower("VENDOR_STATUS")
    pairs = {
        "Total_Success_count": (own == "success", theirs == "success"),
        "Total_Failed_count": (own == "failed", theirs == "failed"),
    }
    every = F.lit(True)
    return (
        pair_counts(enriched, vendor, "VENDOR_REFERENCE", "REFID", pairs)
        .unionByName(count_frame(enriched, {"HUB_Value_count": every}))
        .unionByName(
            count_frame(
                vendor, {"Excel_value_count": every, "Vendor_success_count": every}
            )
        )
    )


def reconcile_qr(
    vendor_file: DataFrame, tables: Tables, start: Day, end: Day, stage: bool = False
) -> Result:
    """``stage`` keeps the payments, bare and with their credits, in the shared folder."""
    vendor = select_existing(
        prepare_vendor(vendor_file, SERVICE),
        ["REFID", "Unique_ID", "VENDOR_DATE", "VENDOR_STATUS", "VENDOR_AMOUNT"],
    )
    hub = qr_transactions(tables, start, end)
    if stage:
        hub = staged(hub)
    enriched = with_wallet_credit(hub, wallet_credits(tables, start, end))
    if stage:
        enriched = staged(enriched)
    return Result(
        buckets=qr_buckets(enriched, hub, vendor),
        counts=qr_counts(enriched, vendor),
        settled=SETTLED,
        unplaced=unplaced_payments(enriched, hub, vendor),
    )
