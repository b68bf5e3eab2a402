"""The internal extract of every common service, and whole service reconciliations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.joins import END, FLAG_NAMES, FLAG_WORDS, START, flags_sql, wallet_sql
from tallybook.catalog.match import CASE
from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.config.hub_services import HUB_SERVICES
from tallybook.plans.hub_extract import hub_extract
from tallybook.plans.hub_recon import reconcile, reconcile_service
from tallybook.sources.tables import Tables

VIEWS = (
    "master",
    "sub",
    "detail",
    "bill_fetch",
    "hub_ledger",
    "tenant_ledger",
    "wallet",
)


def detail_table(s: Source, service: str) -> DataFrame:
    """The generic detail view under the column names of one service."""
    spec = HUB_SERVICES[service]
    names = {"vendor_key": spec.key, "status_code": spec.status, "created": "CreationTs"}
    if spec.amount:
        names["amount"] = spec.amount
    if spec.window != "CreationTs":
        names["confirmed"] = spec.window
    df = s["detail"]
    if spec.key_from:
        df = df.withColumn(spec.key_from[1], F.col("other_id"))
    if spec.amount_from:
        df = df.withColumn(spec.amount_from[1], F.col("other_id"))
    if spec.dimension:
        names["biller"] = spec.dimension[1]
    if spec.mode:
        names["trans_mode"] = spec.mode
    return df.withColumnsRenamed(names)


def tables_for(s: Source, service: str) -> Tables:
    billers = s["nation"].select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("CategoryName")
    )
    requests = s["detail"].select(
        F.col("other_id").alias("id"), F.col("vendor_key").alias("ReferenceNo")
    )
    fetched = s["bill_fetch"].select(
        F.col("Id").alias("id"), F.col("BillAmount").alias("Billedamount")
    )
    return Tables(
        **{
            "MasterTransaction": s["master"],
            "MasterSubTransaction": s["sub"],
            "IHubWalletTransaction": s["hub_ledger"],
            "TenantWalletTransaction": s["tenant_ledger"],
            "EboWalletTransaction": s["wallet"],
            "BBPS_BillerDetail": billers,
            "BBPS_BillFetch": s["bill_fetch"],
            "PsAepsRequest": requests,
            "LicPremiumBillFetch": fetched,
            HUB_SERVICES[service].detail: detail_table(s, service),
        }
    )


# What the checking SQL needs to know of each service: join kind, window column,
# shown date, amount, status labels, wallet pattern, and further columns.
_DAY = "CAST({} AS DATE)"


def _case(column: str, names: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items())
    return f"CASE {column} {whens} ELSE CAST({column} AS STRING) END"


def extract_sql(
    service: str,
    pattern: str,
    codes: dict[int, str],
    join: str = "JOIN",
    window: str = "d.created",
    shown: str | None = None,
    amount: str = "d.amount",
    extra: str = "",
    extra_from: str = "",
    where: str = "",
    key: str = "d.vendor_key",
    tenant_ledger: bool = True,
    backfill: bool = False,
    skip: str = "",
) -> str:
    """CTE ``extract``."""
    within = f"BETWEEN DATE '{START}' AND DATE '{END}'"
    tenant = (
        f"""CASE WHEN m.TransactionRefNum IN (SELECT IHubReferenceId FROM tenant_ledger
    WHERE {_DAY.format("CreationTs")} {within} AND IHubReferenceId IS NOT NULL)
    THEN 'Yes' ELSE 'No' END AS TENANT_LEDGER_STATUS,"""
        if tenant_ledger
        else ""
    )
    flags = ", ".join(f"f.{n}" for n in FLAG_WORDS)
    undated, undated_join = "", ""
    if backfill:
        undated = f""", undated AS (SELECT w.MasterTransactionsId AS mid, {flags_sql()} FROM wallet w
  WHERE w.ServiceName ILIKE '{pattern}' AND w.MasterTransactionsId IS NOT NULL
  GROUP BY w.MasterTransactionsId),
wanted AS (SELECT DISTINCT m.TenantMasterTransactionId AS mid FROM detail d
  JOIN sub s ON d.MasterSubTransactionId = s.Id JOIN master m ON s.MasterTransactionId = m.Id
  LEFT JOIN wallet_flags f ON f.ref = m.TransactionRefNum
  WHERE {_DAY.format(window)} {within} AND f.mid IS NULL)"""
        undated_join = """LEFT JOIN (SELECT u.* FROM undated u JOIN wanted USING (mid)) b
  ON b.mid = m.TenantMasterTransactionId"""
        flags = ", ".join(f"coalesce(b.{n}, f.{n}) AS {n}" for n in FLAG_WORDS)
    return f"""{wallet_sql(pattern, START, END, skip)}{undated},
extract AS (
SELECT m.TransactionRefNum AS IHUB_REFERENCE,
  {_case("m.TenantDetailId", {1: "INET-CSC", 2: "ITI-ESEVA", 3: "UPCB"})} AS TENANT_ID,
  {key} AS VENDOR_REFERENCE, m.CreationUserId AS IHUB_USERNAME,
  {_case("m.TransactionStatus", {0: "initiated", 1: "success", 2: "failed", 3: "inprogress", 4: "partial success"})}
    AS IHUB_MASTER_STATUS,
  s.NetCommissionAddedToEBOWallet AS COMMISSION_AMOUNT,
  {_DAY.format(shown or window)} AS SERVICE_DATE, {amount} AS HUB_AMOUNT,
  {_case("d.status_code", codes)} AS "{service}_STATUS", {extra}
  CASE WHEN m.TransactionRefNum IN (SELECT IHubReferenceId FROM hub_ledger
    WHERE {_DAY.format("CreationTs")} {within} AND IHubReferenceId IS NOT NULL)
    THEN 'Yes' ELSE 'No' END AS IHUB_LEDGER_STATUS,
  {tenant} {flags}
FROM detail d {join} sub s ON d.MasterSubTransactionId = s.Id
{join} master m ON s.MasterTransactionId = m.Id {extra_from}
LEFT JOIN wallet_flags f ON f.ref = m.TransactionRefNum {undated_join}
WHERE {_DAY.format(window)} {within} {where})"""


# Codes, labels and column names of each service, as the checking SQL needs them.
EXTRACTS = {
    "RECHARGE": dict(
        pattern="%All - Recharge%",
        codes={0: "initiated", 1: "success", 2: "pending", 3: "failed", 4: "instant failed"},
    ),
    "BBPS": dict(
        pattern="%BillPayment%",
        codes={0: "unknown", 1: "success", 2: "failed", 3: "inprogress", 4: "partial success"},
        extra=f"""n.n_name AS BBPS_CATEGORY,
  CASE WHEN d.HeadReferenceId IN (SELECT HeadReferenceId FROM bill_fetch
    WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')
    THEN 'Yes' ELSE 'No' END AS BILL_FETCH_STATUS,""",
        extra_from="LEFT JOIN nation n ON n.n_nationkey = d.biller",
    ),
    "PANUTI": dict(
        pattern="%PAN-UTI%", codes={0: "failed", 1: "success"}, join="LEFT JOIN"
    ),
    "DMT": dict(
        pattern="%Money Transfer%",
        codes={
            0: "failedandrefunded",
            1: "success",
            2: "inprocess",
            3: "sendtobank",
            4: "onhold",
            5: "failed",
            111: "tenantwalletinit",
        },
    ),
    "PANNSDL": dict(
        pattern="%Pan Internal%",
        codes={
            0: "None",
            1: "New",
            2: "Acknowledged",
            3: "Rejected",
            4: "Uploaded",
            5: "Processed",
            6: "Reupload",
            7: "Alloted",
        },
        join="LEFT JOIN",
        window="d.confirmed",
        shown="d.created",
        where="AND d.vendor_key IS NOT NULL",
    ),
    "PASSPORT": dict(
        pattern="%Passport%",
        codes={
            0: "unknown",
            1: "NewRequest",
            2: "CallMade",
            3: "AppointmentFixed",
            4: "ApplicationClosed",
            5: "ApplicationRejected",
            6: "ReAppointment",
        },
        join="LEFT JOIN",
        window="d.confirmed",
        backfill=True,
    ),
    "LIC": dict(
        pattern="%LIC%",
        codes={0: "initiated", 1: "success", 2: "failed"},
        join="LEFT JOIN",
        amount="b0.BillAmount",
        extra_from="LEFT JOIN bill_fetch b0 ON b0.Id = d.other_id",
    ),
    "ASTRO": dict(
        pattern="%Astrology%",
        codes={0: "initiated", 1: "unknown", 2: "success"},
        amount="s.TranAmountTotal",
    ),
    "INSURANCE_OFFLINE": dict(
        pattern="%Insurance%",
        codes={0: "unknown", 1: "NewRequest", 2: "InProcess", 3: "Completed", 4: "Rejected"},
        key="trim(d.vendor_key)",
    ),
    "ABHIBUS": dict(
        pattern="%BusBooking%",
        codes={0: "initiated", 2: "success", 3: "failed", 4: "failed and refunded"},
    ),
    "MOVETOBANK": dict(
        pattern="%MoveToBank%",
        codes={
            0: "unknown",
            1: "pending",
            2: "failed",
            3: "success",
            4: "failed and refunded",
        },
        shown="m.CreationTs",
    ),
    "AEPS": dict(
        pattern="%AEPS%",
        codes={
            0: "failed",
            1: "success",
            2: "timeout",
            3: "inprocess",
            254: "failed",
            255: "initiated",
        },
        where="AND d.trans_mode = '2'",
        tenant_ledger=False,
        skip="'Transaction - Credit due to failure',",
    ),
    "MATM": dict(
        pattern="%M-ATM%", codes={0: "unknown", 1: "failed", 2: "success"}
    ),
}


def _mode(service: str) -> str | None:
    return "2" if service == "AEPS" else None


def _register_extract(service: str) -> None:
    @query(
        f"hub_extract_{service.lower()}",
        *VIEWS,
        sql=f"WITH {extract_sql(service, **EXTRACTS[service])} SELECT * FROM extract",
    )
    def run(s: Source) -> DataFrame:
        return hub_extract(tables_for(s, service), service, START, END, _mode(service))


for _service in EXTRACTS:
    _register_extract(_service)


def recon_sql(service: str, vendor: str, columns: str) -> str:
    """Buckets of a service whose keys are compared stripped; ``vendor`` gives the prepared file."""
    return f"""WITH {extract_sql(service, **EXTRACTS[service])},
vend AS ({vendor}),
pairs AS (SELECT e.*, x.*, lower(trim(x.VENDOR_STATUS)) AS v, lower(e.IHUB_MASTER_STATUS) AS h,
    lower(e.IHUB_LEDGER_STATUS) AS l
  FROM extract e JOIN vend x ON trim(e.VENDOR_REFERENCE) = trim(x.REFID))
SELECT {CASE} AS CATEGORY, VENDOR_DATE, VENDOR_AMOUNT, VENDOR_STATUS, REFID, {columns} FROM pairs
UNION ALL
SELECT 'NOT_IN_VENDOR', NULL, NULL, NULL, VENDOR_REFERENCE, {columns} FROM extract e
WHERE NOT EXISTS (SELECT 1 FROM vend x WHERE trim(x.REFID) = trim(e.VENDOR_REFERENCE))
UNION ALL
SELECT 'NOT_IN_PORTAL', VENDOR_DATE, VENDOR_AMOUNT, VENDOR_STATUS, REFID,
  {", ".join("NULL" for _ in columns.split(","))} FROM vend x
WHERE NOT EXISTS (SELECT 1 FROM extract e WHERE trim(x.REFID) = trim(e.VENDOR_REFERENCE))"""


BILL_VENDOR = """SELECT "Transaction Ref ID" AS REFID,
  CAST(try_strptime("Transaction Date", '%d-%b-%Y %H:%M:%S') AS DATE) AS VENDOR_DATE,
  CASE "NPCI Transaction Desc" WHEN 'Successful' THEN 'success' WHEN 'Transaction timed out'
    THEN 'timed out' ELSE 'failed' END AS VENDOR_STATUS,
  TRY_CAST("Transaction Amount(RS.)" AS DOUBLE) AS VENDOR_AMOUNT
FROM vendor_file"""
BILL_COLUMNS = (
    "TENANT_ID, IHUB_REFERENCE, IHUB_USERNAME, BBPS_CATEGORY, HUB_AMOUNT, COMMISSION_AMOUNT,"
    " IHUB_MASTER_STATUS, BBPS_STATUS, SERVICE_DATE, IHUB_LEDGER_STATUS, BILL_FETCH_STATUS,"
    f" TENANT_LEDGER_STATUS, {FLAG_NAMES}"
)


@query(
    "service_recon_bills",
    *VIEWS,
    "vendor_file",
    sql=recon_sql("BBPS", BILL_VENDOR, BILL_COLUMNS),
)
def service_recon_bills(s: Source) -> DataFrame:
    """The whole way: raw vendor file and internal tables to buckets."""
    tables = tables_for(s, "BBPS")
    return reconcile_service("BBPS", s["vendor_file"], tables, START, END).buckets


RECHARGE_COLUMNS = BILL_COLUMNS.replace("BBPS_CATEGORY, ", "").replace(
    "BILL_FETCH_STATUS, ", ""
).replace("BBPS_STATUS", "RECHARGE_STATUS").replace(" BILL_FETCH_STATUS,", "")


@query(
    "service_recon_recharge",
    *VIEWS,
    "vendor",
    sql=recon_sql(
        "RECHARGE",
        "SELECT REFID, VENDOR_DATE, VENDOR_STATUS, VENDOR_AMOUNT FROM vendor",
        RECHARGE_COLUMNS,
    ),
)
def service_recon_recharge(s: Source) -> DataFrame:
    hub = hub_extract(tables_for(s, "RECHARGE"), "RECHARGE", START, END)
    return reconcile(hub, s["vendor"], "RECHARGE").buckets
