"""Payment-QR, transfer, request and bill-entry reconciliations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.audit import shared_folder
from tallybook.catalog.joins import CREDITS_SQL, DAY_END, DAY_START, END, START
from tallybook.catalog.ledgers import count_of, metrics
from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.operators.columns import union_aligned
from tallybook.operators.rules import TRANSFER_RULES
from tallybook.operators.summary import match_summary
from tallybook.plans import bill_entry, qr_recon, requests_recon, transfer_recon
from tallybook.plans.hub_recon import buckets
from tallybook.sources.staging import staged
from tallybook.sources.tables import Tables

WITHIN = f"BETWEEN DATE '{START}' AND DATE '{END}'"

# -------------------------------------------------------------- payment QR

QR_VIEWS = ("qr_payments", "qr_sessions", "wallet", "qr_vendor")


def _clean(c: str) -> str:
    return f"CASE WHEN trim({c}) IN ('None','nan','NULL') THEN NULL ELSE trim({c}) END"


QR_HUB = f"""qr_hub AS (SELECT {_clean("p.ReferenceNo")} AS REFERENCE_NO,
  {_clean("p.BankReferenceNo")} AS VENDOR_REFERENCE,
  CASE p.TransStatus WHEN 0 THEN 'success' WHEN 5 THEN 'inprogress' WHEN 7 THEN 'failed'
    WHEN 255 THEN 'initiated' ELSE CAST(p.TransStatus AS STRING) END AS IHUB_MASTER_STATUS,
  p.TransRemarks AS UPIQR_STATUS, CAST(p.CreationTs AS DATE) AS SERVICE_DATE,
  CASE w.TenantDetailId WHEN 1 THEN 'INET-CSC' WHEN 2 THEN 'ITI-ESEVA' WHEN 3 THEN 'UPCB'
    ELSE CAST(w.TenantDetailId AS STRING) END AS TENANT_ID,
  w.EboUserName AS IHUB_USERNAME, p.Amount AS HUB_AMOUNT, p.RE2 AS TRANS_MODE
  FROM qr_payments p JOIN qr_sessions w ON w.Id = p.WhiteLabelSessionId
  WHERE CAST(p.CreationTs AS DATE) {WITHIN} AND CAST(w.CreationTs AS DATE) {WITHIN})"""

# What tells payments without a bank reference apart.
OWN_REFERENCE = "CASE WHEN VENDOR_REFERENCE IS NULL THEN REFERENCE_NO END"
_FIRST_HUB = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY
  REFERENCE_NO NULLS FIRST, VENDOR_REFERENCE NULLS FIRST, IHUB_MASTER_STATUS, UPIQR_STATUS NULLS FIRST,
  SERVICE_DATE, TENANT_ID, IHUB_USERNAME, HUB_AMOUNT, TRANS_MODE) AS rn FROM qr_hub) WHERE rn = 1"""
_FIRST_CREDIT = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY UNIQUE_REFERENCE ORDER BY
  VendorReferenceId NULLS FIRST, IHubReferenceId NULLS FIRST, ServiceName) AS rc FROM credits
  WHERE TRANSACTION_TYPE = '{origin}' AND UNIQUE_REFERENCE IS NOT NULL) WHERE rc = 1"""


def _branch(key: str, origin: str) -> str:
    return f"""SELECT h.REFERENCE_NO, h.VENDOR_REFERENCE, h.IHUB_MASTER_STATUS, h.UPIQR_STATUS,
  h.SERVICE_DATE, h.TENANT_ID, h.IHUB_USERNAME, h.HUB_AMOUNT, h.TRANS_MODE, c.EBO_WALLET_CREDIT,
  c.TRANSACTION_TYPE, coalesce(c.ServiceName, 'UPIQR') AS SERVICE_NAME, '{origin}' AS MERGE_TYPE
  FROM ({_FIRST_HUB.format(key=f"{key}, {OWN_REFERENCE}")}) h
  LEFT JOIN ({_FIRST_CREDIT.format(origin=origin)}) c ON c.UNIQUE_REFERENCE = h.{key}"""


QR_SQL = f"""{QR_HUB},
{CREDITS_SQL},
enriched AS (SELECT * EXCLUDE (rb) FROM (SELECT *, row_number() OVER (PARTITION BY VENDOR_REFERENCE, {OWN_REFERENCE}
  ORDER BY CASE WHEN TRANSACTION_TYPE IS NULL AND EBO_WALLET_CREDIT IS NULL THEN 1 ELSE 0 END,
    MERGE_TYPE, REFERENCE_NO NULLS FIRST) AS rb
  FROM ({_branch("VENDOR_REFERENCE", "AUTO_CREDIT")}
  UNION ALL {_branch("REFERENCE_NO", "MANUAL_REFUND")}) t) WHERE rb = 1),
waiting AS (SELECT * FROM qr_hub WHERE (VENDOR_REFERENCE IS NULL OR VENDOR_REFERENCE = '0')
  AND REFERENCE_NO IS NOT NULL),
matched AS (SELECT e.*, v.*, lower(v.VENDOR_STATUS) AS v, lower(e.IHUB_MASTER_STATUS) AS h
  FROM enriched e JOIN qr_vendor v ON v.REFID = e.VENDOR_REFERENCE)"""
QR_CASE = """CASE WHEN v = 'success' AND h = 'success' THEN 'VEND_IHUB_SUC'
  WHEN v = 'failed' AND h = 'failed' THEN 'VEND_IHUB_FAIL'
  WHEN v = 'failed' AND h = 'success' THEN 'VEND_FAIL_IHUB_SUC'
  WHEN v = 'success' AND h = 'failed' THEN 'VEND_SUC_IHUB_FAIL'
  WHEN v = 'success' AND h IN ('initiated','inprogress') THEN 'IHUB_INT_VEND_SUC'
  WHEN v = 'failed' AND h IN ('initiated','inprogress') THEN 'VEND_FAIL_IHUB_INT'
  ELSE 'UNCLASSIFIED' END"""
QR_ROWS = f"""
SELECT {QR_CASE} AS CATEGORY, VENDOR_DATE, TENANT_ID, VENDOR_REFERENCE, REFID, REFERENCE_NO, IHUB_USERNAME,
  TRANS_MODE, HUB_AMOUNT, VENDOR_AMOUNT, SERVICE_DATE, VENDOR_STATUS, IHUB_MASTER_STATUS, UPIQR_STATUS,
  EBO_WALLET_CREDIT, TRANSACTION_TYPE FROM matched
UNION ALL SELECT 'NOT_IN_VENDOR', NULL, TENANT_ID, VENDOR_REFERENCE, NULL, REFERENCE_NO, IHUB_USERNAME,
  TRANS_MODE, HUB_AMOUNT, NULL, SERVICE_DATE, NULL, IHUB_MASTER_STATUS, UPIQR_STATUS, EBO_WALLET_CREDIT,
  TRANSACTION_TYPE FROM enriched e WHERE NOT EXISTS (SELECT 1 FROM qr_vendor v WHERE v.Unique_ID = e.REFERENCE_NO)
UNION ALL SELECT 'NOT_IN_PORTAL', VENDOR_DATE, NULL, NULL, REFID, Unique_ID, NULL, NULL, NULL, VENDOR_AMOUNT,
  NULL, VENDOR_STATUS, NULL, NULL, NULL, NULL FROM qr_vendor v
WHERE NOT EXISTS (SELECT 1 FROM qr_hub h WHERE v.Unique_ID = h.REFERENCE_NO)
UNION ALL SELECT 'BANK_REF_NOT_UPDATED', VENDOR_DATE, TENANT_ID, VENDOR_REFERENCE, REFID, REFERENCE_NO,
  IHUB_USERNAME, TRANS_MODE, HUB_AMOUNT, VENDOR_AMOUNT, SERVICE_DATE, VENDOR_STATUS, IHUB_MASTER_STATUS,
  UPIQR_STATUS, NULL, NULL FROM waiting JOIN qr_vendor v ON v.Unique_ID = REFERENCE_NO
UNION ALL SELECT 'SHARED_BANK_REF', NULL, TENANT_ID, VENDOR_REFERENCE, NULL, REFERENCE_NO, IHUB_USERNAME,
  TRANS_MODE, HUB_AMOUNT, NULL, SERVICE_DATE, NULL, IHUB_MASTER_STATUS, UPIQR_STATUS, NULL, NULL FROM qr_hub h
WHERE VENDOR_REFERENCE IS NOT NULL AND REFERENCE_NO IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM enriched e WHERE e.REFERENCE_NO = h.REFERENCE_NO)"""


def qr_tables(s: Source) -> Tables:
    return Tables(
        AxisEpTransaction=s["qr_payments"],
        WhiteLabelSession=s["qr_sessions"],
        EboWalletTransaction=s["wallet"],
    )


def qr_sides(s: Source) -> tuple[DataFrame, DataFrame]:
    tables = qr_tables(s)
    hub = qr_recon.qr_transactions(tables, START, END)
    credits = qr_recon.wallet_credits(tables, START, END)
    return qr_recon.with_wallet_credit(hub, credits), hub


def kept_qr_sides(s: Source) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(enriched, hub, vendor)``, each written once for the buckets that use it."""
    shared_folder(s)
    tables = qr_tables(s)
    hub = staged(qr_recon.qr_transactions(tables, START, END))
    credits = qr_recon.wallet_credits(tables, START, END)
    enriched = staged(qr_recon.with_wallet_credit(hub, credits))
    return enriched, hub, staged(s["qr_vendor"])


@query("upi_two_branch", *QR_VIEWS, sql=f"WITH {QR_SQL} SELECT * FROM enriched")
def upi_two_branch(s: Source) -> DataFrame:
    return qr_sides(s)[0]


@query("upi_buckets", *QR_VIEWS, sql=f"WITH {QR_SQL}{QR_ROWS}")
def upi_buckets(s: Source) -> DataFrame:
    return qr_recon.qr_buckets(*kept_qr_sides(s))


@query(
    "upi_counts",
    *QR_VIEWS,
    sql=f"WITH {QR_SQL}\n"
    + metrics(
        {
            "Total_Success_count": count_of(
                "matched", "lower(UPIQR_STATUS) = 'success' AND v = 'success'"
            ),
            "Total_Failed_count": count_of(
                "matched", "lower(UPIQR_STATUS) = 'failed' AND v = 'failed'"
            ),
            "HUB_Value_count": count_of("enriched"),
            "Excel_value_count": count_of("qr_vendor"),
            "Vendor_success_count": count_of("qr_vendor"),
        }
    ),
)
def upi_counts(s: Source) -> DataFrame:
    return qr_recon.qr_counts(qr_sides(s)[0], s["qr_vendor"])


@query(
    "upi_bank_ref_missing",
    *QR_VIEWS,
    sql=f"""WITH {QR_HUB}, waiting AS (SELECT * FROM qr_hub
  WHERE (VENDOR_REFERENCE IS NULL OR VENDOR_REFERENCE = '0') AND REFERENCE_NO IS NOT NULL)
SELECT REFERENCE_NO, VENDOR_REFERENCE, REFID, VENDOR_AMOUNT FROM waiting JOIN qr_vendor v
  ON v.Unique_ID = REFERENCE_NO""",
)
def upi_bank_ref_missing(s: Source) -> DataFrame:
    hub = qr_recon.qr_transactions(qr_tables(s), START, END)
    return qr_recon.bank_ref_missing(hub, s["qr_vendor"]).select(
        "REFERENCE_NO", "VENDOR_REFERENCE", "REFID", "VENDOR_AMOUNT"
    )


_PAYMENT = """REFERENCE_NO, VENDOR_REFERENCE, IHUB_MASTER_STATUS, UPIQR_STATUS, SERVICE_DATE, TENANT_ID,
  IHUB_USERNAME, HUB_AMOUNT, TRANS_MODE"""
_SHARED = """SELECT h.* FROM qr_hub h WHERE VENDOR_REFERENCE IS NOT NULL AND REFERENCE_NO IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM enriched e WHERE e.REFERENCE_NO = h.REFERENCE_NO)"""
QR_UNPLACED = f"""shown AS (SELECT {_PAYMENT} FROM enriched UNION ALL SELECT {_PAYMENT} FROM ({_SHARED})),
gave_way AS (SELECT {_PAYMENT} FROM qr_hub EXCEPT ALL SELECT {_PAYMENT} FROM shown),
own_only AS (SELECT e.*, v.REFID FROM enriched e JOIN qr_vendor v ON v.Unique_ID = e.REFERENCE_NO
  WHERE e.VENDOR_REFERENCE <> '0' AND NOT EXISTS (SELECT 1 FROM qr_vendor w WHERE w.REFID = e.VENDOR_REFERENCE))"""


@query(
    "upi_unplaced",
    *QR_VIEWS,
    sql=f"""WITH {QR_SQL}, {QR_UNPLACED}
SELECT 'GAVE_WAY' AS CATEGORY, REFERENCE_NO, VENDOR_REFERENCE, NULL AS REFID, HUB_AMOUNT FROM gave_way
UNION ALL SELECT 'OWN_ID_ONLY', REFERENCE_NO, VENDOR_REFERENCE, REFID, HUB_AMOUNT FROM own_only""",
)
def upi_unplaced(s: Source) -> DataFrame:
    """Payments outside the buckets: none of them is lost."""
    enriched, hub = qr_sides(s)
    return qr_recon.unplaced_payments(enriched, hub, s["qr_vendor"]).select(
        "CATEGORY", "REFERENCE_NO", "VENDOR_REFERENCE", "REFID", "HUB_AMOUNT"
    )


@query(
    "upi_row_balance",
    *QR_VIEWS,
    sql=f"""WITH {QR_SQL}, {QR_UNPLACED}
SELECT 'ROWS_IN' AS CATEGORY, count(*) AS n FROM qr_hub
UNION ALL SELECT 'WITH_CREDIT', count(*) FROM enriched
UNION ALL SELECT 'SHARED_BANK_REF', count(*) FROM ({_SHARED})
UNION ALL SELECT 'GAVE_WAY', count(*) FROM gave_way
UNION ALL SELECT 'ROWS_PLACED', (SELECT count(*) FROM shown) + (SELECT count(*) FROM gave_way)""",
)
def upi_row_balance(s: Source) -> DataFrame:
    """Every payment has its credit looked up, shares its bank reference with one that has, or gave way to it."""
    enriched, hub = qr_sides(s)
    gave_way = qr_recon.unplaced_payments(enriched, hub, s["qr_vendor"]).where(
        F.col("CATEGORY") == qr_recon.GAVE_WAY
    )
    parts = {
        "ROWS_IN": hub,
        "WITH_CREDIT": enriched,
        "SHARED_BANK_REF": qr_recon.shared_bank_ref(hub, enriched),
        "GAVE_WAY": gave_way,
    }
    sizes = union_aligned(
        *[df.select(F.lit(name).alias("CATEGORY")) for name, df in parts.items()]
    ).groupBy("CATEGORY").agg(F.count("*").alias("n"))
    placed = sizes.where("CATEGORY <> 'ROWS_IN'").agg(
        F.lit("ROWS_PLACED").alias("CATEGORY"), F.sum("n").alias("n")
    )
    return sizes.unionByName(placed)


# ---------------------------------------------------------------- transfers

TRANSFER_VIEWS = ("transfer_table", "vendor", "portal_users")
TRANSFER_SQL = f"""hub_t AS (SELECT u.apna_id AS ITI_ID, t.utr_no AS ref, t.tot_amt AS ACTUAL_AMOUNT,
  t.trans_amt AS REQUEST_AMOUNT, CAST(t.post_dt AS DATE) AS SERVICE_DATE,
  CASE t.status WHEN '1' THEN 'success' WHEN '0' THEN 'failed' ELSE t.status END AS IMPS_STATUS
  FROM transfer_table t LEFT JOIN portal_users u ON u.id = t.users_id
  WHERE CAST(t.post_dt AS DATE) {WITHIN} AND t.utr_no IS NOT NULL AND t.utr_no <> ''),
pairs AS (SELECT h.*, v.*, lower(v.VENDOR_STATUS) AS vs, lower(h.IMPS_STATUS) AS hs
  FROM hub_t h JOIN vendor v ON h.ref = v.REFID)"""
TRANSFER_CASE = """CASE WHEN vs = 'success' AND hs = 'success' THEN 'VEND_IHUB_SUC'
  WHEN vs = 'failed' AND hs = 'success' THEN 'VEND_FAIL_IHUB_SUC'
  WHEN vs = 'success' AND hs = 'failed' THEN 'VEND_SUC_IHUB_FAIL'
  WHEN vs IN ('failed','timed out') AND hs = 'failed' THEN 'IHUB_FAIL_VEND_FAIL'
  WHEN vs = 'success' AND hs IN ('initiated','inprogress','pending') THEN 'IHUB_INT_VEND_SUC'
  WHEN vs IN ('failed','timed out') AND hs IN ('initiated','inprogress','pending') THEN 'VEND_FAIL_IHUB_INT'
  ELSE 'UNCLASSIFIED' END"""


@query(
    "imps_buckets",
    *TRANSFER_VIEWS,
    sql=f"""WITH {TRANSFER_SQL}
SELECT {TRANSFER_CASE} AS CATEGORY, ITI_ID, REFID, ACTUAL_AMOUNT, REQUEST_AMOUNT, VENDOR_AMOUNT,
  VENDOR_STATUS, IMPS_STATUS, VENDOR_DATE, SERVICE_DATE FROM pairs
UNION ALL SELECT 'NOT_IN_VENDOR', ITI_ID, ref, ACTUAL_AMOUNT, REQUEST_AMOUNT, NULL, NULL, IMPS_STATUS,
  NULL, SERVICE_DATE FROM hub_t h WHERE NOT EXISTS (SELECT 1 FROM vendor v WHERE trim(v.REFID) = trim(h.ref))
UNION ALL SELECT 'NOT_IN_PORTAL', NULL, REFID, NULL, NULL, VENDOR_AMOUNT, VENDOR_STATUS, NULL, VENDOR_DATE,
  NULL FROM vendor v WHERE NOT EXISTS (SELECT 1 FROM hub_t h WHERE h.ref = v.REFID)""",
)
def imps_buckets(s: Source) -> DataFrame:
    tables = Tables(axis_imps_trans=s["transfer_table"], users=s["portal_users"])
    hub = transfer_recon.transfers(tables, START, END)
    return buckets(
        hub,
        s["vendor"],
        transfer_recon.RESULT_COLUMNS,
        TRANSFER_RULES,
        transfer_recon.COLUMNS,
        key_mode="reference",
    )


@query(
    "imps_counts",
    *TRANSFER_VIEWS,
    sql=f"WITH {TRANSFER_SQL}, classified AS (SELECT *, {TRANSFER_CASE} AS category FROM pairs)\n"
    + metrics(
        {
            "matched": count_of("pairs"),
            "Total_Success_count": count_of("pairs", "vs = 'success' AND hs = 'success'"),
            "Total_Failed_count": count_of("pairs", "vs = 'failed' AND hs = 'failed'"),
            **{
                name: count_of("classified", f"category = '{name}'")
                for name in (*[r.category for r in TRANSFER_RULES], "UNCLASSIFIED")
            },
            "HUB_Value_count": count_of("hub_t"),
            "Excel_value_count": count_of("vendor"),
            "Hub_initiated_count": count_of(
                "hub_t", "lower(IMPS_STATUS) IN ('initiated', 'inprogress')"
            ),
            "Hub_success_count": count_of("hub_t", "IMPS_STATUS = 'success'"),
            "Hub_failed_count": count_of("hub_t", "IMPS_STATUS = 'failed'"),
            "Vendor_success_count": count_of("vendor", "lower(VENDOR_STATUS) = 'success'"),
            "Vendor_failed_count": count_of("vendor", "lower(VENDOR_STATUS) = 'failed'"),
            "Vendor_timeout_count": count_of(
                "vendor", "lower(VENDOR_STATUS) = 'timed out'"
            ),
            "NOT_IN_PORTAL": count_of(
                "vendor v", "NOT EXISTS (SELECT 1 FROM hub_t h WHERE h.ref = v.REFID)"
            ),
            "NOT_IN_VENDOR": count_of(
                "hub_t h",
                "NOT EXISTS (SELECT 1 FROM vendor v WHERE trim(v.REFID) = trim(h.ref))",
            ),
        }
    ),
)
def imps_counts(s: Source) -> DataFrame:
    tables = Tables(axis_imps_trans=s["transfer_table"], users=s["portal_users"])
    return match_summary(
        transfer_recon.transfers(tables, START, END),
        s["vendor"],
        TRANSFER_RULES,
        transfer_recon.COLUMNS,
        key_mode="reference",
        late_is_failed=False,
    )


# ----------------------------------------------------------------- requests

DAYS = f"BETWEEN DATE '{DAY_START}' AND DATE '{DAY_END}'"
DISTRICT_COLUMNS = """r.VleId AS VLE_ID, CAST(sv.r_name AS STRING) AS SERVICE_CODE,
  r."Count" AS APPLICATION_COUNT, r.Commission AS RATE, r.Amount AS TOTAL_AMOUNT,
  CASE u.jansevaType WHEN 1 THEN 'Jenseva Kendra' WHEN 2 THEN 'Panchayat Sahayak' ELSE 'EBO' END AS JENSEVA_TYPE,
  CAST(r.CreationTs AS DATE) AS SERVICE_DATE, sd.n_name AS SUB_DISTRICT, a.VillageName AS VILLAGE"""
DISTRICT_JOINS = """LEFT JOIN agents a ON a.id = r.EboDetailId LEFT JOIN users u ON u.id = a.UserId
  LEFT JOIN region sv ON sv.r_regionkey = r.UpeDistrictServiceId
  LEFT JOIN nation sd ON sd.n_nationkey = a.SubDistrictId"""
REQUEST_NAMES = """EBO_ID, USERNAME, VLE_ID, SERVICE_CODE, APPLICATION_COUNT, RATE, TOTAL_AMOUNT, JENSEVA_TYPE,
  SERVICE_DATE, SUB_DISTRICT, VILLAGE"""


def district_sql(key: str, service: str, first: bool) -> str:
    """CTEs ``win`` (one row per key inside the window) and ``hist`` (newest rows of any date)."""
    within = f"{service} AND CAST(CreationTs AS DATE) {DAYS}"

    def chosen(place: str, rows: str) -> str:
        return f"""(SELECT * FROM (SELECT *, {place} AS place FROM district_requests WHERE {rows}) t WHERE place = 1) r"""

    earliest = chosen(f"row_number() OVER (PARTITION BY {key} ORDER BY id)", within)
    newest = f"rank() OVER (PARTITION BY {key} ORDER BY CreationTs DESC)"
    dated = f"{key} IS NOT NULL AND CreationTs IS NOT NULL"
    shown = f"r.{key} AS ref, u.UserName AS EBO_ID, a.Name AS USERNAME, {DISTRICT_COLUMNS}"
    inside = earliest if first else chosen(newest, f"{within} AND {dated}")
    return f"""win AS (SELECT {shown} FROM {inside} {DISTRICT_JOINS}),
hist AS (SELECT {shown} FROM {chosen(newest, f"{service} AND {dated}")} {DISTRICT_JOINS})"""


def portal_sql(key: str, service: str) -> str:
    """As ``district_sql``, with the row of the highest id in and out of the window."""
    shown = f"""r.{key} AS ref, u.apna_id AS EBO_ID, u.f_name AS USERNAME, c.vle_id AS VLE_ID,
  r.service_code AS SERVICE_CODE, r.req_app_count AS APPLICATION_COUNT, r.rate AS RATE,
  r.total_amt AS TOTAL_AMOUNT, CAST(r.created_at AS DATE) AS SERVICE_DATE"""

    def last(rows: str) -> str:
        return f"""SELECT {shown} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY id DESC) AS place
  FROM portal_requests WHERE {rows}) r LEFT JOIN portal_users u ON u.id = r.users_id
  LEFT JOIN portal_centres c ON c.users_id = r.users_id WHERE place = 1"""

    return f"win AS ({last(f'{service} AND CAST(created_at AS DATE) {DAYS}')}), hist AS ({last(service)})"


def topup_sql() -> str:
    key = r"regexp_replace(trim(r.VerifiedUtrNo), '\s+', ' ', 'g')"
    shown = f"""{key} AS ref, u.UserName AS IHUB_USERNAME, u.FirstName AS NAME, b.r_name AS BANK_NAME,
  r.AccountNo AS ACC_NO, r.UtrNo AS UTR_NO, r.Amount AS AMOUNT,
  CASE r.ManualTbStatusType WHEN 0 THEN 'unknown' WHEN 1 THEN 'New Request' WHEN 2 THEN 'Yet To Credit'
    WHEN 3 THEN 'Approved by Accountant' WHEN 4 THEN 'Approved by Accountant Special'
    WHEN 5 THEN 'Approved by Admin' WHEN 6 THEN 'Approved by Admin Special' WHEN 7 THEN 'Cancel'
    ELSE CAST(r.ManualTbStatusType AS STRING) END AS MANUAL_TB_STATUS,
  CAST(r.CreationTs AS DATE) AS SERVICE_DATE"""
    rest = """FROM topup_requests r LEFT JOIN region b ON b.r_regionkey = r.manualTbbankId
  LEFT JOIN agents a ON a.id = r.EboDetailId LEFT JOIN users u ON u.id = a.UserId"""
    return f"""win AS (SELECT {shown} {rest} WHERE CAST(r.CreationTs AS DATE) {DAYS}),
hist AS (SELECT {shown} {rest})"""


REQUEST_PARTS = """drift AS (SELECT * FROM hist WHERE ref IN (SELECT REFID FROM vend WHERE REFID IS NOT NULL)
  AND ref NOT IN (SELECT ref FROM win WHERE ref IS NOT NULL)),
matched AS (SELECT * FROM win JOIN vend ON REFID = ref),
other_date AS (SELECT * FROM drift JOIN vend ON REFID = ref),
hub_only AS (SELECT * FROM win w WHERE NOT EXISTS (SELECT 1 FROM vend WHERE REFID = w.ref)),
vendor_only AS (SELECT * FROM vend v WHERE NOT EXISTS (SELECT 1 FROM win WHERE ref = v.REFID)
  AND NOT EXISTS (SELECT 1 FROM drift WHERE ref = v.REFID))"""


def request_rows_sql(names: str, with_date: bool = True) -> str:
    day = "VENDOR_DATE, " if with_date else ""
    no_day = "NULL, " if with_date else ""
    nulls = ", ".join("NULL" for _ in names.split(","))
    return f"""
SELECT 'MATCHED' AS CATEGORY, REFID, {day}{names} FROM matched
UNION ALL SELECT 'IN_PORTAL_DIFF_DATE', REFID, {day}{names} FROM other_date
UNION ALL SELECT 'NOT_IN_VENDOR', ref, {no_day}{names} FROM hub_only
UNION ALL SELECT 'NOT_IN_PORTAL', REFID, {day}{nulls} FROM vendor_only"""


REQUEST_COUNTS = metrics(
    {
        "Total_Success_count": f"SELECT ({count_of('matched')}) + ({count_of('other_date')})",
        "Total_Failed_count": f"SELECT ({count_of('hub_only')}) + ({count_of('vendor_only')})",
        "HUB_Value_count": f"SELECT ({count_of('win')}) + ({count_of('other_date')})",
        "Excel_value_count": count_of("vend"),
    }
)

DISTRICT_VIEWS = ("district_requests", "agents", "users")
PORTAL_VIEWS = ("portal_requests", "portal_users", "portal_centres")
PORTAL_NAMES = """EBO_ID, USERNAME, VLE_ID, SERVICE_CODE, APPLICATION_COUNT, RATE, TOTAL_AMOUNT, SERVICE_DATE"""
TOPUP_NAMES = """IHUB_USERNAME, NAME, BANK_NAME, ACC_NO, UTR_NO, AMOUNT, MANUAL_TB_STATUS, SERVICE_DATE"""

REQUESTS = {
    "SULTANPURSCA": (
        DISTRICT_VIEWS,
        "request_vendor",
        district_sql("ApplicationId", "UpeDistrictServiceId <> 1", first=True),
        request_rows_sql(REQUEST_NAMES),
    ),
    "SULTANPUR_IS": (
        DISTRICT_VIEWS,
        "quota_vendor",
        district_sql("QuotaId", "UpeDistrictServiceId = 1", first=False),
        request_rows_sql(REQUEST_NAMES),
    ),
    "CHITRAKOOT_SCA": (
        PORTAL_VIEWS,
        "request_vendor",
        portal_sql("application_no", "service_code NOT ILIKE 'IS'"),
        request_rows_sql(PORTAL_NAMES),
    ),
    "CHITRAKOOT_IS": (
        PORTAL_VIEWS,
        "quota_vendor",
        portal_sql("quota_id", "service_code ILIKE 'IS'"),
        request_rows_sql(PORTAL_NAMES),
    ),
    "MANUAL_TB": (
        ("topup_requests", "agents", "users"),
        "topup_vendor",
        topup_sql(),
        request_rows_sql(TOPUP_NAMES, with_date=False),
    ),
}


def request_tables(s: Source) -> Tables:
    services = s["region"].select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("Code")
    )
    banks = s["region"].select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("Name")
    )
    areas = s["nation"].select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("Name")
    )
    return Tables(
        UpeDistrictTransaction=s["district_requests"],
        tb_up_request=s["portal_requests"],
        ManualTbTransaction=s["topup_requests"],
        ManualTbBank=banks,
        EboDetail=s["agents"],
        User=s["users"],
        UpeDistrictService=services,
        SubDistrict=areas,
        users=s["portal_users"],
        users_up=s["portal_centres"],
    )


def request_result(s: Source, service: str, vendor: str):
    tables, side = request_tables(s), s[vendor]
    hub = requests_recon.requests_in_window(tables, service, DAY_START, DAY_END)
    drifted = requests_recon.found_on_other_date(tables, service, side, hub)
    columns = requests_recon.REQUEST_SERVICES[service].columns
    return requests_recon.assemble(hub, side, drifted, columns)


def _register_requests(service: str) -> None:
    views, vendor, ctes, rows = REQUESTS[service]
    vend = f"vend AS (SELECT REFID, VENDOR_DATE FROM {vendor})"

    @query(
        f"up_buckets_{service.lower()}",
        *views,
        vendor,
        sql=f"WITH {ctes},\n{vend},\n{REQUEST_PARTS}{rows}",
    )
    def run_rows(s: Source) -> DataFrame:
        return request_result(s, service, vendor).buckets

    @query(
        f"up_counts_{service.lower()}",
        *views,
        vendor,
        sql=f"WITH {ctes},\n{vend},\n{REQUEST_PARTS}\n{REQUEST_COUNTS}",
    )
    def run_counts(s: Source) -> DataFrame:
        return request_result(s, service, vendor).counts


for _service in REQUESTS:
    _register_requests(_service)

# -------------------------------------------------------------- bill entry


@query(
    "billfetch_enrich",
    "vendor_file",
    "bill_fetch",
    "sub",
    sql=f"""SELECT f."Transaction Ref ID" AS TxnRefId, f."NPCI Ref NO" AS HeadReferenceId,
  CASE f."NPCI Transaction Desc" WHEN 'Successful' THEN '1' WHEN 'Transaction timed out' THEN '2'
    ELSE f."NPCI Transaction Desc" END AS TransactionStatusType,
  b.Id AS BBPS_BillFetchId, b.BBPS_BillerDetailId, b.CustomerMobile, b.BillAmount AS Amount,
  strftime(b.CreationTs, '%Y-%m-%d %H:%M:%S.%f') AS CreationTs, b.HeadReferenceId AS HeadReferenceId_db,
  b.CustomerData, b.CustomerName, b.Request, b.Response, b.CreationUserId, s.Id AS MST_ID,
  s.TransRefNumVendorSub AS VEND_ID
FROM vendor_file f JOIN bill_fetch b ON b.HeadReferenceId = f."NPCI Ref NO"
JOIN (SELECT Id, upper(TransRefNumVendorSub) AS TransRefNumVendorSub, CreationTs FROM sub) s
  ON s.TransRefNumVendorSub = f."Transaction Ref ID"
WHERE CAST(b.CreationTs AS DATE) {WITHIN} AND CAST(s.CreationTs AS DATE) {WITHIN}
  AND s.TransRefNumVendorSub ILIKE '%KM%'""",
)
def billfetch_enrich(s: Source) -> DataFrame:
    subs = s["sub"].withColumn("TransRefNumVendorSub", F.upper("TransRefNumVendorSub"))
    tables = Tables(BBPS_BillFetch=s["bill_fetch"], MasterSubTransaction=subs)
    return bill_entry.bill_entries(s["vendor_file"], tables, START, END)
