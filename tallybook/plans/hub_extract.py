"""Internal transactions of one service, with ledger and wallet flags.

Logical tables: ``MasterTransaction``, ``MasterSubTransaction``, the service's
detail table, ``IHubWalletTransaction``, ``TenantWalletTransaction`` and
``EboWalletTransaction``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import HubService, hub_service
from tallybook.errors import UnknownServiceError
from tallybook.functions._cols import as_col
from tallybook.functions.dates import Day, in_days, in_lookahead
from tallybook.functions.labels import HUB_STATUS, label, tenant_name
from tallybook.functions.text import like_text, strip
from tallybook.operators.match import (
    assert_unique,
    distinct_keys,
    flag_present,
    lookup,
    own_shuffle,
    unique_left_join,
)
from tallybook.operators.wallet import backfill_flags, two_link_flags
from tallybook.sources.tables import Tables

WALLET_COLUMNS = ("MasterTransactionsId", "IHubReferenceId", "Description")


def service_wallet(
    tables: Tables, pattern: str, window: tuple[Day, Day] | None = None
) -> DataFrame:
    """Wallet entries of one service; with a window, those posted up to 30 days after it too."""
    wallet = tables["EboWalletTransaction"].where(like_text("ServiceName", pattern))
    return wallet if window is None else wallet.where(in_lookahead("CreationTs", *window))


def wallet_flags(tables: Tables, spec: HubService, start: Day, end: Day) -> DataFrame:
    master = tables["MasterTransaction"].where(in_days("CreationTs", start, end))
    wallet = service_wallet(tables, spec.wallet_pattern, (start, end))
    return two_link_flags(
        wallet.select(*WALLET_COLUMNS),
        master.select("TransactionRefNum", "TenantMasterTransactionId"),
        spec.flags,
    )


def _details(tables: Tables, spec: HubService, start: Day, end: Day) -> DataFrame:
    d = tables[spec.detail].where(in_days(spec.window, start, end))
    if spec.require_key:
        d = d.where(as_col(spec.key).isNotNull())
    if spec.key_from:
        table, own, other_id, reference = spec.key_from
        d = lookup(
            d,
            tables[table].select(other_id, as_col(reference).alias("VENDOR_REFERENCE")),
            own,
            other_id,
            how="inner",
        )
    else:
        d = d.withColumn("VENDOR_REFERENCE", as_col(spec.key))
    if spec.amount_from:
        table, own, other_id, amount = spec.amount_from
        bills = tables[table].select(other_id, as_col(amount).alias("HUB_AMOUNT"))
        d = lookup(d, bills, own, other_id)
    elif spec.amount:
        d = d.withColumn("HUB_AMOUNT", as_col(spec.amount))
    if spec.dimension:
        table, own, other_id, column, name = spec.dimension
        names = tables[table].select(other_id, as_col(column).alias(name))
        d = lookup(d, names, own, other_id)
    if spec.presence:
        table, own, other, name = spec.presence
        seen = tables[table].where(in_days("CreationTs", start, end))
        d = flag_present(d, seen, own, other, name)
    return d


def _columns(
    spec: HubService, service: str, codes: Mapping[int, str]
) -> dict[str, Column]:
    key = as_col("VENDOR_REFERENCE").cast("string")
    amount = "HUB_AMOUNT" if spec.amount_in_sub is None else "SUB_AMOUNT"
    shown = "MASTER_TS" if spec.shown_master_date else spec.shown_date or spec.window
    out = {
        "IHUB_REFERENCE": as_col("IHUB_REFERENCE"),
        "TENANT_ID": tenant_name("TENANT_ID"),
        "VENDOR_REFERENCE": strip(key) if spec.strip_key else key,
        "IHUB_USERNAME": as_col("IHUB_USERNAME"),
        "IHUB_MASTER_STATUS": label("IHUB_MASTER_STATUS", HUB_STATUS),
        "COMMISSION_AMOUNT": as_col("COMMISSION_AMOUNT"),
        "SERVICE_DATE": as_col(shown).cast("date"),
        "HUB_AMOUNT": as_col(amount),
        f"{service}_STATUS": label("DETAIL_STATUS", codes),
    }
    if spec.dimension:
        out[spec.dimension[4]] = as_col(spec.dimension[4])
    if spec.presence:
        out[spec.presence[3]] = as_col(spec.presence[3])
    if spec.backfill:
        out["TENANT_MASTER_TRANSACTION_ID"] = as_col("TENANT_MASTER_TRANSACTION_ID")
    return out


def service_transactions(
    tables: Tables,
    service: str,
    start: Day,
    end: Day,
    transaction_type: str | None = None,
    legacy_labels: bool = False,
) -> DataFrame:
    """Detail rows of the window joined up to their master transaction.

    The window is applied to the detail table before any join. Where the detail
    table leads, rows without a master transaction are kept.
    """
    spec = hub_service(service)
    details = _details(tables, spec, start, end)
    if spec.mode:
        if transaction_type not in spec.modes:
            raise UnknownServiceError(
                f"{service}: transaction type {transaction_type!r} is not one of {spec.modes}"
            )
        details = details.where(as_col(spec.mode).cast("string") == transaction_type)
    sub = tables["MasterSubTransaction"].select(
        F.col("Id").alias("SUB_ID"),
        F.col("MasterTransactionId").alias("SUB_MASTER_ID"),
        F.col("NetCommissionAddedToEBOWallet").alias("COMMISSION_AMOUNT"),
        F.col("TranAmountTotal").alias("SUB_AMOUNT"),
    )
    master = tables["MasterTransaction"].select(
        F.col("Id").alias("MASTER_ID"),
        F.col("TransactionRefNum").alias("IHUB_REFERENCE"),
        F.col("TenantDetailId").alias("TENANT_ID"),
        F.col("CreationUserId").alias("IHUB_USERNAME"),
        F.col("TransactionStatus").alias("IHUB_MASTER_STATUS"),
        F.col("TenantMasterTransactionId").alias("TENANT_MASTER_TRANSACTION_ID"),
        F.col("CreationTs").alias("MASTER_TS"),
    )
    how = "left" if spec.detail_leads else "inner"
    # A service's own status column may share its name with a master column.
    details = details.withColumnRenamed(spec.status, "DETAIL_STATUS")
    rows = details.join(
        sub, F.col("MasterSubTransactionId") == F.col("SUB_ID"), how
    ).join(master, F.col("SUB_MASTER_ID") == F.col("MASTER_ID"), how)
    codes = {**spec.codes, **(spec.legacy_codes if legacy_labels else {})}
    columns = _columns(spec, service, codes)
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def hub_extract(
    tables: Tables,
    service: str,
    start: Day,
    end: Day,
    transaction_type: str | None = None,
    legacy_labels: bool = False,
    validate: bool = False,
) -> DataFrame:
    """``service_transactions`` with ledger presence and wallet flags.

    ``validate`` first checks that no hub reference repeats, and raises
    ``DuplicateKeyError`` if one does. The wallet side is unique as it is
    grouped by the reference.
    """
    spec = hub_service(service)
    rows = service_transactions(
        tables, service, start, end, transaction_type, legacy_labels
    )

    def posted(ledger: str) -> DataFrame:
        return tables[ledger].where(in_days("CreationTs", start, end))

    rows = flag_present(
        rows,
        posted("IHubWalletTransaction"),
        "IHUB_REFERENCE",
        "IHubReferenceId",
        "IHUB_LEDGER_STATUS",
    )
    if spec.tenant_ledger:
        rows = flag_present(
            rows,
            posted("TenantWalletTransaction"),
            "IHUB_REFERENCE",
            "IHubReferenceId",
            "TENANT_LEDGER_STATUS",
        )
    if validate:
        assert_unique(rows, "IHUB_REFERENCE", f"{service} extract")
    # rows whose detail has no master transaction share the null reference
    flags = own_shuffle(wallet_flags(tables, spec, start, end), "IHubReferenceId")
    rows = unique_left_join(
        rows, flags, "IHUB_REFERENCE", "IHubReferenceId", validate=False
    ).drop("IHubReferenceId")
    if spec.backfill:
        rows = backfill_flags(
            rows,
            service_wallet(tables, spec.wallet_pattern),
            "TENANT_MASTER_TRANSACTION_ID",
            spec.flags,
        )
    return rows.drop("MasterTransactionsId", "TENANT_MASTER_TRANSACTION_ID")


def applications_elsewhere(tables: Tables, start: Day, end: Day) -> DataFrame:
    """Applications known to the second system: rows that may rescue a missing one."""
    users = tables["users"].select("id", F.col("apna_id").alias("IHUB_USERNAME"))
    rows = tables["pan_nsdl"].where(
        in_days("post_dt", start, end) & F.col("application_no").isNotNull()
    )
    return lookup(rows, users, "users_id", "id").select(
        "IHUB_USERNAME",
        strip("application_no").alias("VENDOR_REFERENCE"),
        F.col("amount").alias("HUB_AMOUNT"),
        F.col("status").alias("service_status"),
        F.col("post_dt").cast("date").alias("SERVICE_DATE"),
    )


def tenant_rows_missing_at_hub(
    tenants: list[DataFrame],
    hub_master: DataFrame,
    start: Day,
    end: Day,
    tenant_services: list[int],
    hub_services: list[int],
) -> DataFrame:
    """Transactions of any tenant database that the hub does not have."""
    rows = reduce(DataFrame.unionByName, tenants).where(
        in_days("CreationTs", start, end)
        & F.col("VendorSubServiceMappingId").isin(*tenant_services)
    )
    known = hub_master.where(
        in_days("CreationTs", start, end)
        & F.col("VendorSubServiceMappingId").isin(*hub_services)
    ).select(F.col("TenantMasterTransactionId").alias("__key"))
    return rows.join(distinct_keys(known), F.col("Id") == F.col("__key"), "left_anti")
