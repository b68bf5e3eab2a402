"""Wallet entries reduced to flags and amounts per transaction, and linked to the hub.

Wallet rows are aggregated by their own reference before they meet the hub, so
the join sees one row per reference on both sides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.labels import YES, yes_no
from tallybook.operators.match import exact, join_keys, key_set, own_shuffle

# Wallet entry descriptions behind each flag.
TRANSACTION_CREDIT = (
    "Transaction - Credit",
    "Transaction - Credit due to failure",
    "Transaction - Refund",
    "Manual Refund Credit - Transaction - Credit",
)
TRANSACTION_CREDIT_AEPS = (
    "Transaction - Credit",
    "Transaction - Refund",
    "Manual Refund Credit - Transaction - Credit",
)
TRANSACTION_DEBIT = (
    "Transaction - Debit",
    "Manual Refund Debit - Transaction - Debit",
)
COMMISSION_CREDIT = (
    "Commission Added",
    "Manual Refund Credit - Commission - Added",
)
COMMISSION_REVERSAL = (
    "Commission - Reversal",
    "Commission Reversal",
    "Manual Refund Debit - Commission - Reversal",
)
TOPUP_CREDIT = (
    "Wallet topup - Credit",
    "Manual Refund Credit - Transaction - Credit",
)

WALLET_FLAGS = {
    "TRANSACTION_CREDIT": TRANSACTION_CREDIT,
    "TRANSACTION_DEBIT": TRANSACTION_DEBIT,
    "COMMISSION_CREDIT": COMMISSION_CREDIT,
    "COMMISSION_REVERSAL": COMMISSION_REVERSAL,
}
WALLET_FLAGS_AEPS = {**WALLET_FLAGS, "TRANSACTION_CREDIT": TRANSACTION_CREDIT_AEPS}

Flags = Mapping[str, Sequence[str]]


def flag_aggregates(flags: Flags, description: str = "Description") -> list[Column]:
    """``Yes`` if any entry of the group has one of the descriptions.

    Folded as booleans, which a hash aggregation can hold; text would need a sort.
    """
    return [
        yes_no(F.bool_or(as_col(description).isin(*words))).alias(name)
        for name, words in flags.items()
    ]


def merge_flags(flags: Flags) -> list[Column]:
    """Flags already computed, OR-ed over a group; null if all are null."""
    found = {name: F.bool_or(as_col(name) == YES) for name in flags}
    return [F.when(c.isNotNull(), yes_no(c)).alias(name) for name, c in found.items()]


def max_amount(
    amount: str, words: Sequence[str], name: str, description: str = "Description"
) -> Column:
    """Largest amount among entries with one of the descriptions, 0 if there is none."""
    return F.max(
        F.when(as_col(description).isin(*words), as_col(amount)).otherwise(F.lit(0))
    ).alias(name)


def two_link_flags(
    wallet: DataFrame,
    master: DataFrame,
    flags: Flags = WALLET_FLAGS,
) -> DataFrame:
    """Flags per hub reference from wallet entries that point to it in either of two ways.

    An entry names the tenant's transaction id, or the hub reference, or both.
    Wallet and master are each read once: a row is turned into one row per link
    it has, both sides are grouped by link, and one equi-join brings them
    together. The two answers for a hub reference are then folded, which also
    fills the tenant id in where only one of the links knows it. Inputs are
    ``wallet`` (MasterTransactionsId, IHubReferenceId, Description) and
    ``master`` (TransactionRefNum, TenantMasterTransactionId), both already cut
    to their windows.
    """
    link = ["__kind", "__key"]
    entries = (
        _by_link(wallet, "MasterTransactionsId", "IHubReferenceId")
        .groupBy(*link)
        .agg(
            F.max("MasterTransactionsId").alias("MasterTransactionsId"),
            *flag_aggregates(flags),
        )
    )
    references = (
        _by_link(master, "TenantMasterTransactionId", "TransactionRefNum")
        .groupBy(*link)
        .agg(F.max("TransactionRefNum").alias("IHubReferenceId"))
    )
    return fold_null_ids(entries.join(references, link), flags)


def _by_link(df: DataFrame, tenant_id: str, reference: str) -> DataFrame:
    """One row per usable link: ``T`` with the tenant's id, ``R`` with the hub reference."""
    links = F.array(
        F.struct(
            F.lit("T").alias("kind"), as_col(tenant_id).cast("string").alias("key")
        ),
        F.struct(
            F.lit("R").alias("kind"), as_col(reference).cast("string").alias("key")
        ),
    )
    rows = df.withColumn("__link", F.explode(links))
    return rows.select(
        *df.columns,
        F.col("__link.kind").alias("__kind"),
        F.col("__link.key").alias("__key"),
    ).where(F.col("__key").isNotNull())


def fold_null_ids(
    rows: DataFrame,
    flags: Flags = WALLET_FLAGS,
    reference: str = "IHubReferenceId",
    master_id: str = "MasterTransactionsId",
) -> DataFrame:
    """One row per reference: flags OR-ed, the id taken from whichever row has one."""
    return rows.groupBy(as_col(reference)).agg(
        F.max(as_col(master_id)).alias(master_id), *merge_flags(flags)
    )


def amounts_and_flags(
    wallet: DataFrame, master: DataFrame, flags: Flags = WALLET_FLAGS
) -> DataFrame:
    """Per tenant transaction id: hub and vendor reference, largest debit and credit, flags."""
    entries = (
        wallet.where(F.col("MasterTransactionsId").isNotNull())
        .groupBy("MasterTransactionsId")
        .agg(
            F.max("VendorReferenceId").alias("VENDOR_REF_ID"),
            max_amount("DebitAmount", TRANSACTION_DEBIT, "DEBIT_AMOUNT"),
            max_amount("CreditAmount", TRANSACTION_CREDIT, "CREDIT_AMOUNT"),
            *flag_aggregates(flags),
        )
        .withColumnRenamed("MasterTransactionsId", "TNT_MASTER_TRANSACTION_ID")
    )
    hub = (
        master.where(F.col("TenantMasterTransactionId").isNotNull())
        .groupBy(
            F.col("TenantMasterTransactionId").alias("TNT_MASTER_TRANSACTION_ID")
        )
        .agg(F.max("TransactionRefNum").alias("IHUB_REFERENCE_ID"))
    )
    return hub.join(entries, "TNT_MASTER_TRANSACTION_ID").select(
        "IHUB_REFERENCE_ID",
        "TNT_MASTER_TRANSACTION_ID",
        "VENDOR_REF_ID",
        "DEBIT_AMOUNT",
        "CREDIT_AMOUNT",
        *flags,
    )


def backfill_flags(
    rows: DataFrame,
    undated_wallet: DataFrame,
    id_column: str,
    flags: Flags = WALLET_FLAGS,
    hit_column: str = "MasterTransactionsId",
) -> DataFrame:
    """Flags of rows whose wallet window had no hit, filled from the wallet of all dates.

    Only ids that need it are looked up (semi join before the aggregation).
    Every row with a looked-up id takes the looked-up flags.
    """
    wanted = key_set(rows.where(as_col(hit_column).isNull()), id_column, exact)
    found = (
        undated_wallet.withColumn("__key", as_col("MasterTransactionsId"))
        .join(wanted, "__key", "left_semi")
        .groupBy("__key")
        .agg(*flag_aggregates(flags))
        .withColumnsRenamed({name: f"__{name}" for name in flags})
    )
    joined = join_keys(rows, own_shuffle(found, "__key"), id_column, exact, "left")
    filled = joined.withColumns(
        {n: F.coalesce(as_col(f"__{n}"), as_col(n)) for n in flags}
    )
    return filled.drop(*[f"__{n}" for n in flags])

