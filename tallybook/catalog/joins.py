"""Membership, lookups, latest rows, wallet links, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.functions.dates import in_days
from tallybook.functions.text import null_words_to_null
from tallybook.operators import latest, match, wallet
from tallybook.operators.columns import union_aligned
from tallybook.plans import hub_recon, qr_recon
from tallybook.plans.hub_extract import (
    applications_elsewhere,
    tenant_rows_missing_at_hub,
)
from tallybook.plans.wallet_report import ticket_wallet_report
from tallybook.sources.tables import Tables

START, END = "1996-01-01", "2000-06-30"
DAY_START, DAY_END = "2024-01-06", "2024-01-20"

FLAG_WORDS = {
    "TRANSACTION_CREDIT": "'Transaction - Credit','Transaction - Credit due to failure',"
    "'Transaction - Refund','Manual Refund Credit - Transaction - Credit'",
    "TRANSACTION_DEBIT": "'Transaction - Debit','Manual Refund Debit - Transaction - Debit'",
    "COMMISSION_CREDIT": "'Commission Added','Manual Refund Credit - Commission - Added'",
    "COMMISSION_REVERSAL": "'Commission - Reversal','Commission Reversal',"
    "'Manual Refund Debit - Commission - Reversal'",
}
FLAG_NAMES = ", ".join(FLAG_WORDS)


def flags_sql(prefix: str = "w.", skip: str = "") -> str:
    """Four flag aggregates over ``Description``."""
    return ",\n  ".join(
        f"max(CASE WHEN {prefix}Description IN ({words.replace(skip, '') if skip else words})"
        f" THEN 'Yes' ELSE 'No' END) AS {name}"
        for name, words in FLAG_WORDS.items()
    )


MAX_FLAGS = ", ".join(f"max({n}) AS {n}" for n in FLAG_WORDS)


def wallet_sql(pattern: str, start: str, end: str, skip: str = "") -> str:
    """CTE ``wallet_flags``: per hub reference the tenant id and four flags, over both links.

    A list of (reference, entry) pairs from either link, grouped once. A tenant id that
    several references share belongs to the greatest of them.
    """
    flags = ", ".join(
        f"CASE WHEN bool_or(Description IN ({words.replace(skip, '') if skip else words}))"
        f" THEN 'Yes' ELSE 'No' END AS {name}"
        for name, words in FLAG_WORDS.items()
    )
    return f"""hub_window AS (SELECT TransactionRefNum AS ref, TenantMasterTransactionId AS tenant
  FROM master WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'),
owners AS (SELECT tenant, max(ref) AS ref FROM hub_window GROUP BY tenant),
entries AS (SELECT * FROM wallet
  WHERE CreationTs >= DATE '{start}' AND CreationTs <= DATE '{end}' + 30 AND ServiceName ILIKE '{pattern}'),
linked AS (
  SELECT o.ref, e.MasterTransactionsId, e.Description
  FROM entries e JOIN owners o ON e.MasterTransactionsId = o.tenant
  UNION ALL
  SELECT e.IHubReferenceId, e.MasterTransactionsId, e.Description
  FROM entries e WHERE e.IHubReferenceId IN (SELECT ref FROM hub_window)),
wallet_flags AS (SELECT ref, max(MasterTransactionsId) AS mid, {flags} FROM linked GROUP BY ref)"""


@query(
    "anti_other_keys",
    "qr_payments",
    "qr_vendor",
    sql="""SELECT 'NOT_IN_VENDOR' AS CATEGORY, ReferenceNo AS ref FROM qr_payments p
WHERE NOT EXISTS (SELECT 1 FROM qr_vendor v WHERE v.Unique_ID = p.ReferenceNo)
UNION ALL SELECT 'NOT_IN_PORTAL', Unique_ID FROM qr_vendor v
WHERE NOT EXISTS (SELECT 1 FROM qr_payments p WHERE v.Unique_ID = p.ReferenceNo)""",
)
def anti_other_keys(s: Source) -> DataFrame:
    left, right = match.outer_split(
        s["qr_payments"], s["qr_vendor"], "ReferenceNo", "Unique_ID", match.exact
    )
    return left.select(
        F.lit("NOT_IN_VENDOR").alias("CATEGORY"), F.col("ReferenceNo").alias("ref")
    ).unionByName(
        right.select(
            F.lit("NOT_IN_PORTAL").alias("CATEGORY"), F.col("Unique_ID").alias("ref")
        )
    )


RESCUE_SQL = f"""missing AS (SELECT * FROM vendor v WHERE NOT EXISTS (
  SELECT 1 FROM hub h WHERE h.VENDOR_REFERENCE = v.REFID)),
other AS (SELECT trim(application_no) AS ref, amount, CAST(post_dt AS DATE) AS day,
  CASE status WHEN 1 THEN 'success' WHEN 2 THEN 'initiated' WHEN 3 THEN 'failed'
    ELSE CAST(status AS STRING) END AS state
  FROM elsewhere WHERE CAST(post_dt AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')"""


@query(
    "semi_rescue",
    "hub",
    "vendor",
    "elsewhere",
    sql=f"""WITH {RESCUE_SQL}
SELECT 'MATCHED_IN_ITI' AS CATEGORY, REFID, VENDOR_AMOUNT, amount AS HUB_AMOUNT,
  state AS STATUS, day AS SERVICE_DATE
FROM missing JOIN other ON ref = REFID
UNION ALL
SELECT 'NOT_IN_PORTAL', REFID, VENDOR_AMOUNT, NULL, NULL, NULL FROM missing
WHERE NOT EXISTS (SELECT 1 FROM other WHERE ref = REFID)""",
)
def semi_rescue(s: Source) -> DataFrame:
    users = s["users"].select("id", F.col("UserName").alias("apna_id"))
    tables = Tables(users=users, pan_nsdl=s["elsewhere"])
    other = applications_elsewhere(tables, START, END)
    missing = hub_recon.not_in_portal(s["hub"], s["vendor"], key_mode="reference")
    found, rest = hub_recon.rescue(missing, other, "reference")
    return union_aligned(
        found.select(
            F.lit("MATCHED_IN_ITI").alias("CATEGORY"),
            "REFID",
            "VENDOR_AMOUNT",
            "HUB_AMOUNT",
            F.col("ITI_PAN_NSDL_STATUS").alias("STATUS"),
            "SERVICE_DATE",
        ),
        rest.select(F.lit("NOT_IN_PORTAL").alias("CATEGORY"), "REFID", "VENDOR_AMOUNT"),
    )


@query(
    "unique_left_join",
    "hub",
    "master",
    sql="""SELECT h.IHUB_REFERENCE, h.HUB_AMOUNT, m.TransactionRefNum, m.TenantMasterTransactionId
FROM hub h LEFT JOIN master m ON m.TransactionRefNum = h.IHUB_REFERENCE""",
)
def unique_left_join_query(s: Source) -> DataFrame:
    left = s["hub"].select("IHUB_REFERENCE", "HUB_AMOUNT")
    right = s["master"].select("TransactionRefNum", "TenantMasterTransactionId")
    return match.unique_left_join(left, right, "IHUB_REFERENCE", "TransactionRefNum")


@query(
    "ledger_flags",
    "master",
    "hub_ledger",
    "tenant_ledger",
    sql=f"""SELECT m.Id, m.TransactionRefNum,
  CASE WHEN a.r IS NOT NULL THEN 'Yes' ELSE 'No' END AS IHUB_LEDGER_STATUS,
  CASE WHEN b.r IS NOT NULL THEN 'Yes' ELSE 'No' END AS TENANT_LEDGER_STATUS
FROM master m
LEFT JOIN (SELECT DISTINCT IHubReferenceId AS r FROM hub_ledger
  WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}') a ON a.r = m.TransactionRefNum
LEFT JOIN (SELECT DISTINCT IHubReferenceId AS r FROM tenant_ledger
  WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}') b ON b.r = m.TransactionRefNum""",
)
def ledger_flags(s: Source) -> DataFrame:
    rows = s["master"].select("Id", "TransactionRefNum")
    for ledger, name in (
        ("hub_ledger", "IHUB_LEDGER_STATUS"),
        ("tenant_ledger", "TENANT_LEDGER_STATUS"),
    ):
        posted = s[ledger].where(in_days("CreationTs", START, END))
        rows = match.flag_present(
            rows, posted, "TransactionRefNum", "IHubReferenceId", name
        )
    return rows


@query(
    "membership_flags",
    "detail",
    "bill_fetch",
    sql=f"""SELECT other_id, HeadReferenceId,
  CASE WHEN HeadReferenceId IN (SELECT HeadReferenceId FROM bill_fetch
    WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}') THEN 'Yes' ELSE 'No' END
    AS BILL_FETCH_STATUS
FROM detail""",
)
def membership_flags(s: Source) -> DataFrame:
    fetched = s["bill_fetch"].where(in_days("CreationTs", START, END))
    rows = s["detail"].select("other_id", "HeadReferenceId")
    return match.flag_present(
        rows, fetched, "HeadReferenceId", "HeadReferenceId", "BILL_FETCH_STATUS"
    )


WINDOWED = f"CAST(CreationTs AS DATE) BETWEEN DATE '{DAY_START}' AND DATE '{DAY_END}'"


@query(
    "first_by_id",
    "district_requests",
    sql=f"""SELECT r.id, r.ApplicationId, r.Amount FROM district_requests r
JOIN (SELECT min(id) AS id FROM district_requests WHERE {WINDOWED}
  AND UpeDistrictServiceId NOT IN (1) GROUP BY ApplicationId) f ON f.id = r.id""",
)
def first_by_id(s: Source) -> DataFrame:
    rows = s["district_requests"].where(
        in_days("CreationTs", DAY_START, DAY_END) & (F.col("UpeDistrictServiceId") != 1)
    )
    return latest.keep_first(rows, "ApplicationId", "id").select(
        "id", "ApplicationId", "Amount"
    )


@query(
    "latest_by_id",
    "portal_requests",
    sql="""SELECT r.id, r.application_no, r.total_amt FROM portal_requests r
JOIN (SELECT max(id) AS id FROM portal_requests WHERE service_code NOT ILIKE 'IS'
  GROUP BY application_no) f ON f.id = r.id""",
)
def latest_by_id(s: Source) -> DataFrame:
    rows = s["portal_requests"].where(~F.col("service_code").ilike("IS"))
    return latest.keep_last(rows, "application_no", "id").select(
        "id", "application_no", "total_amt"
    )


@query(
    "latest_by_ts_ties",
    "district_requests",
    sql=f"""SELECT r.id, r.QuotaId, r.Amount FROM district_requests r
JOIN (SELECT QuotaId, max(CreationTs) AS ts FROM district_requests WHERE {WINDOWED}
  GROUP BY QuotaId) f ON f.QuotaId = r.QuotaId AND f.ts = r.CreationTs""",
)
def latest_by_ts_ties(s: Source) -> DataFrame:
    rows = s["district_requests"].where(in_days("CreationTs", DAY_START, DAY_END))
    return latest.keep_newest_with_ties(rows, "QuotaId", "CreationTs").select(
        "id", "QuotaId", "Amount"
    )


@query(
    "date_drift",
    "district_requests",
    "request_vendor",
    sql=f"""WITH present AS (SELECT DISTINCT ApplicationId AS k FROM district_requests WHERE {WINDOWED}),
asked AS (SELECT DISTINCT REFID AS k FROM request_vendor
  WHERE REFID IS NOT NULL AND REFID NOT IN (SELECT k FROM present WHERE k IS NOT NULL))
SELECT d.id, d.ApplicationId FROM district_requests d JOIN asked ON asked.k = d.ApplicationId""",
)
def date_drift(s: Source) -> DataFrame:
    history = s["district_requests"]
    present = history.where(in_days("CreationTs", DAY_START, DAY_END))
    return latest.only_keys_missing_from(
        history, s["request_vendor"], present, "ApplicationId", "REFID"
    ).select("id", "ApplicationId")


@query(
    "wallet_flags_two_link",
    "master",
    "wallet",
    sql=f"""WITH {wallet_sql("%A%", START, END)}
SELECT ref AS IHubReferenceId, mid AS MasterTransactionsId, {FLAG_NAMES} FROM wallet_flags""",
)
def wallet_flags_two_link(s: Source) -> DataFrame:
    entries = s["wallet"].where(
        (F.col("CreationTs") >= F.lit(START).cast("date"))
        & (F.col("CreationTs") <= F.date_add(F.lit(END).cast("date"), 30))
        & F.col("ServiceName").ilike("%A%")
    )
    master = s["master"].where(in_days("CreationTs", START, END))
    return wallet.two_link_flags(entries, master)


@query(
    "wallet_null_fold",
    "wallet",
    sql=f"""WITH grouped AS (SELECT IHubReferenceId, MasterTransactionsId, {flags_sql()}
  FROM wallet w GROUP BY IHubReferenceId, MasterTransactionsId)
SELECT IHubReferenceId, max(MasterTransactionsId) AS MasterTransactionsId, {MAX_FLAGS}
FROM grouped GROUP BY IHubReferenceId""",
)
def wallet_null_fold(s: Source) -> DataFrame:
    grouped = (
        s["wallet"]
        .groupBy("IHubReferenceId", "MasterTransactionsId")
        .agg(*wallet.flag_aggregates(wallet.WALLET_FLAGS))
    )
    return wallet.fold_null_ids(grouped)


@query(
    "wallet_amount_max",
    "master",
    "wallet",
    sql=f"""SELECT max(m.TransactionRefNum) AS IHUB_REFERENCE_ID,
  w.MasterTransactionsId AS TNT_MASTER_TRANSACTION_ID, max(w.VendorReferenceId) AS VENDOR_REF_ID,
  max(CASE WHEN w.Description IN ({FLAG_WORDS["TRANSACTION_DEBIT"]}) THEN w.DebitAmount ELSE 0 END)
    AS DEBIT_AMOUNT,
  max(CASE WHEN w.Description IN ({FLAG_WORDS["TRANSACTION_CREDIT"]}) THEN w.CreditAmount ELSE 0 END)
    AS CREDIT_AMOUNT,
  {flags_sql()}
FROM master m JOIN wallet w ON m.TenantMasterTransactionId = w.MasterTransactionsId
WHERE m.CreationTs >= DATE '{START}' AND m.CreationTs < DATE '{END}' + 1
  AND w.CreationTs >= DATE '{START}' AND w.CreationTs <= DATE '{END}' + 30
  AND w.ServiceName ILIKE '%IRCTC%'
GROUP BY w.MasterTransactionsId""",
)
def wallet_amount_max(s: Source) -> DataFrame:
    tables = Tables(EboWalletTransaction=s["wallet"], MasterTransaction=s["master"])
    return ticket_wallet_report(tables, START, END)


@query(
    "backfill_flags",
    "master",
    "wallet",
    sql=f"""WITH dated AS (SELECT w.MasterTransactionsId, {flags_sql()} FROM wallet w
  WHERE w.CreationTs < DATE '1998-01-01' AND w.MasterTransactionsId IS NOT NULL
  GROUP BY w.MasterTransactionsId),
undated AS (SELECT w.MasterTransactionsId, {flags_sql()} FROM wallet w GROUP BY w.MasterTransactionsId)
SELECT m.Id, d.MasterTransactionsId,
  {", ".join(f"coalesce(CASE WHEN d.MasterTransactionsId IS NULL THEN u.{n} END, d.{n}) AS {n}" for n in FLAG_WORDS)}
FROM master m
LEFT JOIN dated d ON d.MasterTransactionsId = m.TenantMasterTransactionId
LEFT JOIN undated u ON u.MasterTransactionsId = m.TenantMasterTransactionId""",
)
def backfill_flags_query(s: Source) -> DataFrame:
    dated = (
        s["wallet"]
        .where(
            (F.col("CreationTs") < F.lit("1998-01-01").cast("date"))
            & F.col("MasterTransactionsId").isNotNull()
        )
        .groupBy("MasterTransactionsId")
        .agg(*wallet.flag_aggregates(wallet.WALLET_FLAGS))
    )
    rows = match.unique_left_join(
        s["master"].select("Id", "TenantMasterTransactionId"),
        dated,
        "TenantMasterTransactionId",
        "MasterTransactionsId",
        validate=False,
    )
    filled = wallet.backfill_flags(rows, s["wallet"], "TenantMasterTransactionId")
    return filled.drop("TenantMasterTransactionId")


@query(
    "tenant_missing_at_hub",
    "master",
    "sub",
    sql=f"""WITH rows AS (
SELECT Id, Amount FROM (
  SELECT o_orderkey + 1000000000000 AS Id, o_totalprice AS Amount, o_orderdate AS CreationTs FROM orders
  UNION ALL SELECT o_orderkey + 2000000000000, o_totalprice, o_orderdate FROM orders
  UNION ALL SELECT l_orderkey + 1000000000000, l_extendedprice, l_shipdate FROM lineitem) t
WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')
SELECT Id, Amount FROM rows r WHERE NOT EXISTS (SELECT 1 FROM master m
  WHERE m.TenantMasterTransactionId = r.Id AND m.VendorSubServiceMappingId IN (1, 2, 3, 4)
  AND CAST(m.CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')""",
)
def tenant_missing_at_hub(s: Source) -> DataFrame:
    def tenant(df: DataFrame, key: str, amount: str, stamp: str, shift: int) -> DataFrame:
        return df.select(
            (F.col(key) + F.lit(shift)).alias("Id"),
            F.col(amount).alias("Amount"),
            F.col(stamp).alias("CreationTs"),
            F.lit(5).alias("VendorSubServiceMappingId"),
        )

    o, l = s["orders"], s["lineitem"]
    return tenant_rows_missing_at_hub(
        [
            tenant(o, "o_orderkey", "o_totalprice", "o_orderdate", 1_000_000_000_000),
            tenant(o, "o_orderkey", "o_totalprice", "o_orderdate", 2_000_000_000_000),
            tenant(l, "l_orderkey", "l_extendedprice", "l_shipdate", 1_000_000_000_000),
        ],
        s["master"],
        START,
        END,
        [5],
        [1, 2, 3, 4],
    ).select("Id", "Amount")


CREDITS_SQL = f"""credits AS (
SELECT VendorReferenceId, IHubReferenceId, ServiceName,
  max(CASE WHEN Description IN ('Wallet topup - Credit','Manual Refund Credit - Transaction - Credit')
    THEN 'Yes' ELSE 'No' END) AS EBO_WALLET_CREDIT,
  trim(coalesce(VendorReferenceId, IHubReferenceId)) AS UNIQUE_REFERENCE,
  CASE WHEN VendorReferenceId IS NOT NULL THEN 'AUTO_CREDIT'
       WHEN IHubReferenceId IS NOT NULL THEN 'MANUAL_REFUND' ELSE 'UNKNOWN' END AS TRANSACTION_TYPE
FROM wallet
WHERE CreationTs >= DATE '{START}' AND CreationTs < DATE '{END}' + 30 AND ServiceName ILIKE '%UPI%'
GROUP BY VendorReferenceId, IHubReferenceId, ServiceName)"""


@query(
    "wallet_group_three_keys",
    "wallet",
    sql=f"WITH {CREDITS_SQL} SELECT * FROM credits",
)
def wallet_group_three_keys(s: Source) -> DataFrame:
    return qr_recon.wallet_credits(
        Tables(EboWalletTransaction=s["wallet"]), START, END
    )


@query(
    "dedup_first",
    "qr_payments",
    sql="""SELECT ReferenceNo, BankReferenceNo, Amount FROM (
SELECT *, row_number() OVER (PARTITION BY BankReferenceNo ORDER BY ReferenceNo, Amount) AS rn
FROM (SELECT ReferenceNo, CASE WHEN trim(BankReferenceNo) IN ('None','nan','NULL') THEN NULL
  ELSE trim(BankReferenceNo) END AS BankReferenceNo, Amount FROM qr_payments) t) WHERE rn = 1""",
)
def dedup_first(s: Source) -> DataFrame:
    rows = s["qr_payments"].select(
        "ReferenceNo",
        null_words_to_null("BankReferenceNo").alias("BankReferenceNo"),
        "Amount",
    )
    return latest.keep_first(rows, "BankReferenceNo", "ReferenceNo")


@query(
    "dedup_best",
    "wallet",
    sql="""SELECT VENDOR_REFERENCE, EBO_WALLET_CREDIT, TRANSACTION_TYPE, MERGE_TYPE, REFERENCE_NO FROM (
SELECT *, row_number() OVER (PARTITION BY VENDOR_REFERENCE,
  CASE WHEN VENDOR_REFERENCE IS NULL THEN REFERENCE_NO END ORDER BY
  CASE WHEN TRANSACTION_TYPE IS NULL AND EBO_WALLET_CREDIT IS NULL THEN 1 ELSE 0 END,
  MERGE_TYPE, REFERENCE_NO NULLS FIRST) AS rn
FROM (SELECT DISTINCT trim(VendorReferenceId) AS VENDOR_REFERENCE,
    CASE WHEN Description LIKE 'Wallet%' THEN 'Yes' END AS EBO_WALLET_CREDIT,
    CASE WHEN Description LIKE 'Wallet%' THEN 'AUTO_CREDIT' END AS TRANSACTION_TYPE,
    CASE WHEN IHubReferenceId IS NULL THEN 'AUTO_CREDIT' ELSE 'MANUAL_REFUND' END AS MERGE_TYPE,
    IHubReferenceId AS REFERENCE_NO FROM wallet) t) WHERE rn = 1""",
)
def dedup_best(s: Source) -> DataFrame:
    topup = F.col("Description").like("Wallet%")
    rows = s["wallet"].select(
        F.trim("VendorReferenceId").alias("VENDOR_REFERENCE"),
        F.when(topup, F.lit("Yes")).alias("EBO_WALLET_CREDIT"),
        F.when(topup, F.lit("AUTO_CREDIT")).alias("TRANSACTION_TYPE"),
        F.when(F.col("IHubReferenceId").isNull(), F.lit("AUTO_CREDIT"))
        .otherwise(F.lit("MANUAL_REFUND"))
        .alias("MERGE_TYPE"),
        F.col("IHubReferenceId").alias("REFERENCE_NO"),
    )
    return qr_recon.keep_best_credit(rows)


@query(
    "explained_rows_removed",
    "hub",
    "vendor",
    "elsewhere",
    sql="""SELECT REFID, VENDOR_AMOUNT FROM vendor v
WHERE REFID IS NULL OR (REFID NOT IN (SELECT VENDOR_REFERENCE FROM hub WHERE VENDOR_REFERENCE IS NOT NULL)
  AND REFID NOT IN (SELECT application_no FROM elsewhere))""",
)
def explained_rows_removed(s: Source) -> DataFrame:
    return match.drop_explained(
        s["vendor"],
        (s["hub"], "VENDOR_REFERENCE"),
        (s["elsewhere"], "application_no"),
        key="REFID",
    ).select("REFID", "VENDOR_AMOUNT")
