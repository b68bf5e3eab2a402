"""Payment tables derived from the test tables.

Each view covers all rows of the tables it reads. Missing, padded, blank and
unknown keys are made by rewriting keys, never by leaving rows out. The text is
the same for both engines but for quoting and date formats.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallybook.catalog.dialect import SPARK, Dialect

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)


@dataclass(frozen=True)
class View:
    uses: tuple[str, ...]
    build: Callable[[Dialect], str]

    def sql(self, d: Dialect) -> str:
        return self.build(d)


VIEWS: dict[str, View] = {}


def view(name: str, *uses: str):
    def register(build: Callable[[Dialect], str]):
        VIEWS[name] = View(uses, build)
        return build

    return register


class Source:
    """Base tables and views of one data directory as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._make(name)
        return self._frames[name]

    def _make(self, name: str) -> DataFrame:
        if name in VIEWS:
            v = VIEWS[name]
            return self.spark.sql(v.sql(SPARK), **{u: self[u] for u in v.uses})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


# ---------------------------------------------------------------- two sides


@view("hub", "orders")
def _hub(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT concat('IH', {k}) AS IHUB_REFERENCE,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN '  '
            WHEN o_orderkey % 53 = 0 THEN concat(' KM', {k}, ' ')
            WHEN o_orderkey % 19 = 0 THEN concat('ZZ', {k})
            ELSE concat('KM', {k}) END AS VENDOR_REFERENCE,
       CAST(o_orderkey % 4 + 1 AS INT) AS TENANT_ID,
       o_custkey AS IHUB_USERNAME,
       CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'initiated' WHEN 1 THEN 'Success'
            WHEN 2 THEN 'failed' WHEN 3 THEN 'inprogress' WHEN 4 THEN 'partial success'
            ELSE 'pending' END AS IHUB_MASTER_STATUS,
       o_totalprice AS HUB_AMOUNT,
       CAST(o_orderdate AS DATE) AS SERVICE_DATE,
       CASE WHEN o_orderkey % 5 < 2 THEN 'No' ELSE 'Yes' END AS IHUB_LEDGER_STATUS
FROM {d.table("orders")}"""


@view("vendor", "lineitem")
def _vendor(d: Dialect) -> str:
    k = _s("l_orderkey")
    return f"""
SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL
            WHEN l_orderkey % 61 = 0 THEN concat('KM', {k}, ' ')
            ELSE concat('KM', {k}) END AS REFID,
       CASE CAST(sum(l_linenumber) % 6 AS INT) WHEN 0 THEN 'success' WHEN 1 THEN 'Success'
            WHEN 2 THEN 'failed' WHEN 3 THEN 'timed out' WHEN 4 THEN 'weird'
            ELSE NULL END AS VENDOR_STATUS,
       max(l_extendedprice) AS VENDOR_AMOUNT,
       CAST(min(l_shipdate) AS DATE) AS VENDOR_DATE
FROM {d.table("lineitem")} GROUP BY l_orderkey, l_linestatus"""


@view("elsewhere", "orders")
def _elsewhere(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT CASE WHEN o_orderkey % 38 = 0 THEN concat('KM', {k}) ELSE concat('PN', {k}) END
           AS application_no,
       o_totalprice AS amount,
       CAST(o_orderkey % 4 AS INT) AS status,
       o_orderdate AS post_dt,
       o_custkey AS users_id
FROM {d.table("orders")}"""


# ------------------------------------------------------------- vendor files


@view("vendor_file", "lineitem")
def _vendor_file(d: Dialect) -> str:
    k = _s("l_orderkey")
    return f"""
SELECT concat('KM', {k}) AS {d.name("Transaction Ref ID")},
       CASE WHEN l_orderkey % 43 = 0 THEN 'no date'
            ELSE {d.text("min(l_shipdate)", "dd-MMM-yyyy HH:mm:ss")} END
           AS {d.name("Transaction Date")},
       CASE CAST(sum(l_linenumber) % 5 AS INT) WHEN 0 THEN 'Successful' WHEN 1 THEN 'Failure'
            WHEN 2 THEN 'Transaction timed out' WHEN 3 THEN NULL ELSE 'Pending' END
           AS {d.name("NPCI Transaction Desc")},
       CASE WHEN l_orderkey % 47 = 0 THEN 'n/a' ELSE {_money("max(l_extendedprice)")} END
           AS {d.name("Transaction Amount(RS.)")},
       concat('HD', {k}) AS {d.name("NPCI Ref NO")},
       'x' AS Remark
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


@view("messy", "orders")
def _messy(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT o_orderkey AS id,
       CASE CAST(o_orderkey % 8 AS INT)
            WHEN 0 THEN concat('  key  ', {k}, '   x ')
            WHEN 1 THEN 'None' WHEN 2 THEN 'nan' WHEN 3 THEN 'NULL'
            WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN ' NaN '
            ELSE concat('A', {k}) END AS key_text,
       CASE CAST(o_orderkey % 9 AS INT)
            WHEN 0 THEN concat({k}, '.0') WHEN 1 THEN {_money("o_totalprice")}
            WHEN 2 THEN concat(' ', {k}, ' ') WHEN 3 THEN 'nan' WHEN 4 THEN NULL
            WHEN 5 THEN concat('00', {k}) WHEN 6 THEN 'abc'
            WHEN 7 THEN concat('-', {_money("o_totalprice")})
            ELSE concat('₹ ', {_money("o_totalprice")}) END AS number_text,
       {_money("o_totalprice")} AS amount_a,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'bad'
            ELSE {_money("floor(o_totalprice / 10)")} END AS amount_b,
       CASE CAST(o_orderkey % 5 AS INT)
            WHEN 0 THEN {d.text("o_orderdate", "MM/dd/yyyy")}
            WHEN 1 THEN {d.text("o_orderdate", "ddMMyyyy")}
            WHEN 2 THEN {d.text("o_orderdate", "yyyy-MM-dd")}
            WHEN 3 THEN 'soon' ELSE NULL END AS date_text,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'no refund here'
            ELSE concat('Refund Date : ', {d.text("o_orderdate", "yyyy-MM-dd")},
                        ' Txnid', {k}, ' BBPS-AB1-REF-KM', {k}, '-',
                        {d.text("o_orderdate", "MM/dd/yyyy")}) END AS note,
       CAST(o_orderkey % 7 AS INT) AS code,
       CAST(o_orderkey % 5 AS INT) AS tenant,
       o_orderpriority AS priority,
       o_orderdate AS stamp
FROM {d.table("orders")}"""


@view("statuses", "lineitem")
def _statuses(d: Dialect) -> str:
    return f"""
SELECT l_orderkey AS id, l_linenumber AS line,
       CASE CAST((l_orderkey + l_linenumber) % 12 AS INT)
            WHEN 0 THEN 'Successful' WHEN 1 THEN 'Failure' WHEN 2 THEN 'Transaction timed out'
            WHEN 3 THEN 'Processed' WHEN 4 THEN 'Rolled Back' WHEN 5 THEN 'Not Processed'
            WHEN 6 THEN 'Success' WHEN 7 THEN 'Payment Refunded' WHEN 8 THEN 'PROCESSED'
            WHEN 9 THEN '' WHEN 10 THEN NULL ELSE 'Failed' END AS word,
       CASE CAST((l_orderkey + l_suppkey) % 7 AS INT)
            WHEN 0 THEN 'Payment REFUNDED due to x' WHEN 1 THEN 'Accepted by office'
            WHEN 2 THEN 'AUTH_SUCCESS 00' WHEN 3 THEN ' Authorised' WHEN 4 THEN 'AUTHORISED'
            WHEN 5 THEN NULL ELSE '  plain ' END AS phrase
FROM {d.table("lineitem")}"""


# ---------------------------------------------------------- internal tables


@view("master", "orders")
def _master(d: Dialect) -> str:
    return f"""
SELECT o_orderkey AS Id,
       concat('IH', {_s("o_orderkey")}) AS TransactionRefNum,
       CAST(o_orderkey % 4 + 1 AS INT) AS TenantDetailId,
       o_custkey AS CreationUserId,
       CAST(o_orderkey % 6 AS INT) AS TransactionStatus,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey + 1000000000000 END
           AS TenantMasterTransactionId,
       CAST(o_orderkey % 7 AS INT) AS VendorSubServiceMappingId,
       o_orderdate AS CreationTs
FROM {d.table("orders")}"""


@view("sub", "orders")
def _sub(d: Dialect) -> str:
    return f"""
SELECT o_orderkey * 2 + 1 AS Id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey END AS MasterTransactionId,
       o_totalprice AS NetCommissionAddedToEBOWallet,
       o_totalprice + 1 AS TranAmountTotal,
       CASE WHEN o_orderkey % 9 = 0 THEN concat('XX', {_s("o_orderkey")})
            ELSE concat('km', {_s("o_orderkey")}) END AS TransRefNumVendorSub,
       o_orderdate AS CreationTs
FROM {d.table("orders")}"""


@view("detail", "lineitem")
def _detail(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_orderkey * 2 + 1 END
           AS MasterSubTransactionId,
       CASE WHEN l_orderkey % 37 = 0 THEN NULL
            ELSE concat(' KM', {_s("l_orderkey")}) END AS vendor_key,
       CAST(sum(l_linenumber) % 8 AS INT) AS status_code,
       max(l_extendedprice) AS amount,
       min(l_shipdate) AS created,
       max(l_shipdate) AS confirmed,
       CASE WHEN l_orderkey % 3 = 0 THEN '2' WHEN l_orderkey % 3 = 1 THEN '3' ELSE '4' END
           AS trans_mode,
       l_orderkey AS other_id,
       concat('HD', {_s("l_orderkey")}) AS HeadReferenceId,
       l_orderkey % 25 AS biller
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


@view("bill_fetch", "orders")
def _bill_fetch(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT o_orderkey AS Id, o_orderkey % 25 AS BBPS_BillerDetailId,
       concat('M', {k}) AS CustomerMobile,
       o_totalprice AS BillAmount, o_orderdate AS CreationTs,
       CASE WHEN o_orderkey % 8 = 0 THEN concat('HX', {k}) ELSE concat('HD', {k}) END
           AS HeadReferenceId,
       o_orderpriority AS CustomerData, concat('C', {_s("o_custkey")}) AS CustomerName,
       concat('<q>', {k}) AS Request, concat('<a>', {k}) AS Response,
       o_custkey AS CreationUserId
FROM {d.table("orders")}"""


@view("hub_ledger", "lineitem")
def _hub_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_returnflag = 'N' THEN concat('IX', {_s("l_orderkey")})
            WHEN l_suppkey % 10 = 0 THEN NULL
            ELSE concat('IH', {_s("l_orderkey")}) END AS IHubReferenceId,
       l_shipdate AS CreationTs
FROM {d.table("lineitem")}"""


@view("tenant_ledger", "lineitem")
def _tenant_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_linenumber < 5 THEN concat('IX', {_s("l_orderkey")})
            ELSE concat('IH', {_s("l_orderkey")}) END AS IHubReferenceId,
       l_shipdate AS CreationTs
FROM {d.table("lineitem")}"""


@view("wallet", "lineitem")
def _wallet(d: Dialect) -> str:
    k = _s("l_orderkey")
    return f"""
SELECT CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_orderkey + 1000000000000 END
           AS MasterTransactionsId,
       CASE WHEN l_suppkey % 7 BETWEEN 1 AND 3 THEN NULL ELSE concat('IH', {k}) END
           AS IHubReferenceId,
       CASE WHEN l_suppkey % 4 < 2 THEN NULL WHEN l_suppkey % 4 = 2 THEN concat('BK', {k})
            ELSE concat(' BK', {k}) END AS VendorReferenceId,
       CASE CAST(l_partkey % 16 AS INT)
            WHEN 0 THEN 'Astrology' WHEN 1 THEN 'BusBooking' WHEN 2 THEN 'BillPayment'
            WHEN 3 THEN 'Money Transfer' WHEN 4 THEN 'Insurance' WHEN 5 THEN 'LIC'
            WHEN 6 THEN 'M-ATM' WHEN 7 THEN 'MoveToBank' WHEN 8 THEN 'All - Recharge'
            WHEN 9 THEN 'AEPS' WHEN 10 THEN 'PAN-UTI' WHEN 11 THEN 'Pan Internal'
            WHEN 12 THEN 'passport' WHEN 13 THEN 'IRCTC' WHEN 14 THEN 'upi collect'
            ELSE 'UPI/QR' END AS ServiceName,
       CASE CAST((l_linenumber + l_suppkey) % 9 AS INT)
            WHEN 0 THEN 'Transaction - Debit' WHEN 1 THEN 'Transaction - Credit'
            WHEN 2 THEN 'Commission Added' WHEN 3 THEN 'Commission - Reversal'
            WHEN 4 THEN 'Transaction - Credit due to failure'
            WHEN 5 THEN 'Manual Refund Credit - Transaction - Credit'
            WHEN 6 THEN 'Wallet topup - Credit' WHEN 7 THEN NULL
            ELSE 'Commission Reversal' END AS Description,
       l_extendedprice AS DebitAmount,
       l_extendedprice + 1 AS CreditAmount,
       l_shipdate AS CreationTs
FROM {d.table("lineitem")}"""


# -------------------------------------------------------- payment-QR tables


@view("qr_payments", "orders")
def _qr_payments(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT CASE WHEN o_orderkey % 31 = 0 THEN 'None' ELSE concat('UR', {k}) END AS ReferenceNo,
       CASE WHEN o_orderkey % 23 = 0 THEN '0' WHEN o_orderkey % 29 = 0 THEN 'nan'
            WHEN o_orderkey % 27 = 0 THEN NULL
            WHEN o_orderkey % 10 = 3 THEN concat('BK', {_s("o_orderkey - 1")})
            ELSE concat('BK', {k}) END AS BankReferenceNo,
       CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 7
            WHEN 3 THEN 255 ELSE 9 END AS TransStatus,
       CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'Success' WHEN 1 THEN 'FAILED'
            WHEN 2 THEN NULL ELSE 'success' END AS TransRemarks,
       o_totalprice AS Amount, o_orderstatus AS RE2,
       o_orderdate AS CreationTs, o_custkey AS WhiteLabelSessionId
FROM {d.table("orders")}"""


@view("qr_sessions", "customer")
def _qr_sessions(d: Dialect) -> str:
    return f"""
SELECT c_custkey AS Id, CAST(c_custkey % 4 + 1 AS INT) AS TenantDetailId,
       c_name AS EboUserName,
       CAST({d.add_days("DATE '1995-06-01'", "c_custkey * 37 % 1900")} AS TIMESTAMP) AS CreationTs
FROM {d.table("customer")}"""


@view("qr_vendor", "lineitem")
def _qr_vendor(d: Dialect) -> str:
    k = _s("l_orderkey")
    return f"""
SELECT CASE WHEN l_orderkey % 41 = 0 THEN concat('UV', {k}) ELSE concat('UR', {k}) END
           AS Unique_ID,
       CASE WHEN l_orderkey % 33 = 0 THEN NULL ELSE concat('BK', {k}) END AS REFID,
       CASE CAST(sum(l_linenumber) % 3 AS INT) WHEN 0 THEN 'success' WHEN 1 THEN 'failed'
            ELSE 'other' END AS VENDOR_STATUS,
       max(l_extendedprice) AS VENDOR_AMOUNT,
       CAST(min(l_shipdate) AS DATE) AS VENDOR_DATE
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


# ------------------------------------------------------------ transfer table


@view("transfer_table", "orders")
def _transfer_table(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''
            WHEN o_orderkey % 53 = 0 THEN concat('KM', {k}, ' ')
            WHEN o_orderkey % 19 = 0 THEN concat('ZZ', {k})
            ELSE concat('KM', {k}) END AS utr_no,
       o_totalprice AS tot_amt, o_totalprice - 1 AS trans_amt,
       o_orderdate AS post_dt,
       CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2'
            WHEN 3 THEN 'Initiated' ELSE 'pending' END AS status,
       o_custkey AS users_id
FROM {d.table("orders")}"""


# ------------------------------------------------------------ request tables


@view("district_requests", "events")
def _district_requests(d: Dialect) -> str:
    u = _s("user_id")
    return f"""
SELECT event_id AS id,
       CASE WHEN event_id % 67 = 0 THEN NULL ELSE concat('A', {u}, event_type, {_s("event_id % 4")}) END
           AS ApplicationId,
       concat('Q', {u}, '-', {_s("event_id % 6")}) AS QuotaId,
       CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'error' THEN 2
            WHEN 'signup' THEN 3 ELSE 9 END AS UpeDistrictServiceId,
       user_id AS VleId, user_id AS EboDetailId,
       CAST(event_id % 5 AS INT) AS {d.name("Count")},
       value AS Commission, value * 2 AS Amount,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS CreationTs
FROM {d.table("events")}"""


@view("request_vendor", "events")
def _request_vendor(d: Dialect) -> str:
    u = _s("user_id")
    return f"""
SELECT CASE WHEN user_id % 17 = 0 THEN concat('B', {u}, event_type)
            WHEN user_id % 29 = 0 THEN NULL
            ELSE concat('A', {u}, event_type, {_s("event_id % 4")}) END AS REFID,
       CAST(max(ts) AS DATE) AS VENDOR_DATE
FROM {d.table("events")} GROUP BY user_id, event_type, event_id % 4"""


@view("quota_vendor", "events")
def _quota_vendor(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN user_id % 13 = 0 THEN concat('Q-none', {_s("user_id")})
            ELSE concat('Q', {_s("user_id")}, '-', {_s("event_id % 6")}) END AS REFID,
       CAST(max(ts) AS DATE) AS VENDOR_DATE
FROM {d.table("events")} GROUP BY user_id, event_id % 6"""


@view("portal_requests", "events")
def _portal_requests(d: Dialect) -> str:
    u = _s("user_id")
    return f"""
SELECT event_id AS id,
       concat('A', {u}, event_type, {_s("event_id % 4")}) AS application_no,
       concat('Q', {u}, '-', {_s("event_id % 6")}) AS quota_id,
       CASE event_type WHEN 'click' THEN 'IS' WHEN 'view' THEN 'is' WHEN 'error' THEN NULL
            ELSE 'SCA' END AS service_code,
       CAST(event_id % 5 AS INT) AS req_app_count,
       value AS rate, value * 2 AS total_amt, user_id AS users_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at
FROM {d.table("events")}"""


@view("topup_requests", "events")
def _topup_requests(d: Dialect) -> str:
    u = _s("user_id")
    return f"""
SELECT event_id AS id,
       CASE WHEN event_id % 3 = 0 THEN concat(' UTR  ', {u}, '  ', event_type, {_s("event_id % 4")})
            ELSE concat('UTR ', {u}, ' ', event_type, {_s("event_id % 4")}) END AS VerifiedUtrNo,
       concat('U', {_s("event_id")}) AS UtrNo, concat('AC', {u}) AS AccountNo,
       value AS Amount, CAST(event_id % 9 AS INT) AS ManualTbStatusType,
       user_id % 5 AS manualTbbankId, user_id AS EboDetailId,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS CreationTs
FROM {d.table("events")}"""


@view("topup_vendor", "events")
def _topup_vendor(d: Dialect) -> str:
    u = _s("user_id")
    return f"""
SELECT CASE WHEN user_id % 17 = 0 THEN concat('NONE ', {u})
            ELSE concat('UTR ', {u}, ' ', event_type, {_s("event_id % 4")}) END AS REFID,
       CAST(max(ts) AS DATE) AS VENDOR_DATE
FROM {d.table("events")} GROUP BY user_id, event_type, event_id % 4"""


@view("agents", "customer")
def _agents(d: Dialect) -> str:
    return f"""
SELECT c_custkey AS id, c_name AS Name, c_mktsegment AS VillageName,
       CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE c_custkey + 1 END AS UserId,
       c_nationkey AS SubDistrictId
FROM {d.table("customer")}"""


@view("users", "customer")
def _users(d: Dialect) -> str:
    k = _s("c_custkey")
    return f"""
SELECT c_custkey AS id,
       concat(CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'TN' WHEN 1 THEN 'tn'
                   WHEN 2 THEN 'UP01' WHEN 3 THEN 'AP' WHEN 4 THEN 'UPPS' ELSE 'KL' END, {k})
           AS UserName,
       c_name AS FirstName, concat('V', {k}) AS VleId, concat('9', {k}) AS MobileNo,
       concat(c_name, '@example.com') AS Email,
       CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 2 END AS UserRoleId,
       CAST(c_custkey % 4 AS INT) AS jansevaType
FROM {d.table("customer")}"""


@view("portal_users", "customer")
def _portal_users(d: Dialect) -> str:
    k = _s("c_custkey")
    return f"""
SELECT c_custkey AS id,
       concat(CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'UPPS' WHEN 1 THEN 'xup'
                   WHEN 2 THEN 'UP' ELSE 'TN' END, {k}) AS apna_id,
       c_name AS f_name, concat('9', {k}) AS phone_no,
       concat(c_name, '@example.com') AS email_id,
       CASE WHEN c_custkey % 33 = 0 THEN TIMESTAMP '1971-05-05 00:00:00'
            ELSE CAST({d.add_days("DATE '1997-01-01'", "c_custkey * 37 % 1100")} AS TIMESTAMP) END
           AS next_due_date,
       CAST(c_custkey % 3 + 3 AS INT) AS mas_user_type_id,
       CAST(c_custkey % 5 AS INT) AS up_vle_status
FROM {d.table("customer")}"""


@view("portal_centres", "customer")
def _portal_centres(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS users_id,
       concat('VL', {_s("c_custkey")}) AS vle_id
FROM {d.table("customer")}"""


@view("packages_bought", "orders")
def _packages_bought(d: Dialect) -> str:
    return f"""
SELECT o_custkey AS UserId, CAST(o_orderkey % 6 AS INT) AS PackageId,
       CASE WHEN o_orderkey % 41 = 0 THEN TIMESTAMP '1971-01-01 00:00:00'
            ELSE CAST(o_orderdate AS TIMESTAMP) END AS ExpireTs
FROM {d.table("orders")}"""


@view("packages", "region")
def _packages(d: Dialect) -> str:
    return f"SELECT r_regionkey AS id, r_name AS Name FROM {d.table('region')}"


@view("instalments", "lineitem")
def _instalments(d: Dialect) -> str:
    return f"""
SELECT l_suppkey AS users_id,
       CASE WHEN l_suppkey % 3 = 0 THEN 1 WHEN l_linestatus = 'O' THEN 1
            WHEN l_linenumber = 7 THEN 2 ELSE 0 END AS payment_sts
FROM {d.table("lineitem")}"""


# --------------------------------------------- vendor ledgers and statements


@view("refund_statement", "orders")
def _refund_statement(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT CASE WHEN o_orderkey % 59 = 0 THEN concat('T', {k}, ' ') ELSE concat('T', {k}) END
           AS TXNID,
       CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'failed' WHEN 1 THEN ' Failed '
            WHEN 2 THEN NULL ELSE 'success' END AS STATUS,
       {_money("o_totalprice")} AS AMOUNT,
       {_money("floor(o_totalprice / 100)")} AS {d.name("NET COMMISSION")},
       {_money("floor(o_totalprice / 1000)")} AS TDS,
       {d.text("o_orderdate", "yyyy-MM-dd HH:mm:ss")} AS DATE,
       concat(' R', {k}, ' ') AS REFID,
       CASE WHEN o_orderkey % 6 = 5 THEN NULL
            ELSE concat('Date : ', {d.text("o_orderdate", "yyyy-MM-dd")},
                        ' Txnid', {_s("o_orderkey + 500000000000")}) END AS REFUND
FROM {d.table("orders")}"""


@view("refund_ledger", "orders", "lineitem")
def _refund_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_orderkey % 23 = 0 THEN concat('S', {_s("l_orderkey")})
            ELSE concat('T', {_s("l_orderkey")}) END AS TXNID,
       'Debit' AS TYPE, {_money("max(l_extendedprice)")} AS AMOUNT,
       {_money("min(l_extendedprice)")} AS {d.name("COMM/SHARE")},
       '1.00' AS TDS, {d.text("min(l_shipdate)", "yyyy-MM-dd")} AS DATE,
       concat('R', {_s("l_orderkey")}) AS REFID
FROM {d.table("lineitem")} GROUP BY l_orderkey
UNION ALL
SELECT CASE WHEN o_orderkey % 7 = 0 THEN concat('N', {_s("o_orderkey")})
            ELSE {_s("o_orderkey + 500000000000")} END AS TXNID,
       'CREDIT' AS TYPE, {_money("o_totalprice")} AS AMOUNT,
       {_money("floor(o_totalprice / 100)")} AS {d.name("COMM/SHARE")},
       '0.00' AS TDS, {d.text("o_orderdate", "yyyy-MM-dd")} AS DATE,
       concat('R', {_s("o_orderkey")}) AS REFID
FROM {d.table("orders")}"""


@view("column_refund_statement", "orders")
def _column_refund_statement(d: Dialect) -> str:
    k = _s("o_orderkey")
    return f"""
SELECT concat('T', {k}) AS TXNID,
       CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'Refunded to wallet' WHEN 1 THEN 'Success'
            WHEN 2 THEN NULL ELSE 'REFUNDED' END AS STATUS,
       {_money("o_totalprice")} AS AMOUNT, {_money("floor(o_totalprice / 100)")} AS COMM,
       {_money("floor(o_totalprice / 1000)")} AS TDS,
       {d.text("o_orderdate", "yyyy-MM-dd")} AS DATE,
       concat('R', {k}) AS REFID,
       concat('Date : ', {d.text("o_orderdate", "yyyy-MM-dd")}) AS REFUND,
       CASE WHEN o_orderkey % 6 = 5 THEN NULL
            ELSE concat(' ', {_s("o_orderkey + 500000000000")}) END AS REFUNDTXNID
FROM {d.table("orders")}"""


@view("settled_statement", "lineitem")
def _settled_statement(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_suppkey % 40 = 0 THEN NULL WHEN l_suppkey % 40 = 1 THEN {_s("-l_orderkey - 1")}
            ELSE concat({_s("l_orderkey * 2")}, '.0') END AS SETTLED_ID,
       {_money("l_extendedprice")} AS AMOUNT,
       {_money("floor(l_extendedprice / 100)")} AS COMMISSION,
       CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'N' THEN 'FAILED' ELSE NULL END AS STATUS,
       concat({_s("l_orderkey * 10 + l_linenumber")}, '.0') AS SERIALNUMBER,
       concat('AK', {_s("l_partkey")}) AS ACKNO,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE {_s("l_partkey")} END AS UTR
FROM {d.table("lineitem")}"""


@view("settlement_ledger", "orders", "lineitem")
def _settlement_ledger(d: Dialect) -> str:
    return f"""
SELECT {_s("l_orderkey * 2")} AS SNO,
       CASE WHEN l_orderkey % 31 = 0 THEN ' Bank SETTLEMENT ' WHEN l_orderkey % 37 = 0 THEN NULL
            ELSE 'Withdrawal' END AS TXNTYPE,
       'Debit' AS {d.name("Type ")},
       CASE WHEN l_orderkey % 10 = 0 THEN {_money("sum(l_extendedprice) + 1")}
            ELSE CAST(sum(CASE WHEN l_suppkey % 40 > 1 THEN CAST(l_extendedprice AS DECIMAL(18,2))
                               ELSE CAST(0 AS DECIMAL(18,2)) END) AS STRING) END AS AMOUNT,
       {d.text("min(l_shipdate)", "yyyy-MM-dd")} AS DATE
FROM {d.table("lineitem")} GROUP BY l_orderkey
UNION ALL
SELECT CASE WHEN o_orderkey % 6 = 0 THEN {_s("-o_orderkey * 2 - 2000000")}
            ELSE {_s("o_orderkey * 2 + 1")} END AS SNO,
       CASE WHEN o_orderkey % 45 = 0 THEN 'MiniStatement' ELSE 'Commission' END AS TXNTYPE,
       ' credit ' AS {d.name("Type ")},
       {_money("floor(o_totalprice / 100)")} AS AMOUNT,
       {d.text("o_orderdate", "yyyy-MM-dd")} AS DATE
FROM {d.table("orders")}"""


@view("atm_ledger", "orders")
def _atm_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN o_orderkey % 19 = 0 THEN concat('Z', {_s("o_orderkey")})
            WHEN o_orderkey % 43 = 0 THEN NULL
            ELSE {_s("o_orderkey + 100000000000")} END AS UTR,
       CASE WHEN o_orderkey % 11 = 0 THEN 'free' WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE concat('₹ ', {_money("o_totalprice")}) END AS Amount,
       CASE WHEN o_orderkey % 3 = 0 THEN ' CR' ELSE 'Dr' END AS {d.name("Cr/Dr")},
       {d.text("o_orderdate", "yyyy-MM-dd")} AS Date
FROM {d.table("orders")}"""


@view("atm_statement", "orders", "lineitem")
def _atm_statement(d: Dialect) -> str:
    # the amount agrees in whole units for two orders in three
    return f"""
SELECT CASE WHEN o_orderkey % 17 = 0 THEN concat('Y', {_s("o_orderkey")})
            WHEN o_orderkey % 29 = 0 THEN NULL
            ELSE concat({_s("o_orderkey + 100000000000")}, '.0') END AS RRN,
       CASE WHEN o_orderkey % 3 = 0 THEN {_money("o_totalprice + 5")}
            WHEN o_orderkey % 3 = 1 THEN {_s("CAST(floor(o_totalprice) AS BIGINT)")}
            ELSE {_money("o_totalprice")} END AS Amount,
       concat('BC', {_s("o_custkey")}) AS bcid, o_orderstatus AS TransactionStatus
FROM {d.table("orders")}"""


@view("bank_ledger", "orders", "lineitem")
def _bank_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_orderkey % 23 = 0 THEN concat('KMX', {_s("l_orderkey")})
            WHEN l_orderkey % 47 = 0 THEN concat('CHQ', {_s("l_orderkey")})
            WHEN l_orderkey % 51 = 0 THEN NULL
            ELSE concat(' KM', {_s("l_orderkey")}) END AS {d.name("Chq / Ref No.")},
       CASE WHEN l_orderkey % 14 = 0 THEN '1' ELSE {_money("max(l_extendedprice)")} END AS Debit,
       CAST(NULL AS STRING) AS Credit,
       'bill payment' AS Description,
       {d.text("min(l_shipdate)", "dd/MM/yyyy")} AS {d.name("Transaction Date")}
FROM {d.table("lineitem")} GROUP BY l_orderkey
UNION ALL
SELECT concat('CR', {_s("l_orderkey")}) AS {d.name("Chq / Ref No.")},
       CAST(NULL AS STRING) AS Debit,
       CASE WHEN l_orderkey % 7 = 0 THEN '2' WHEN l_orderkey % 9 = 0 THEN NULL
            ELSE {_s("CAST(floor(max(l_extendedprice)) AS BIGINT)")} END AS Credit,
       CASE WHEN l_orderkey % 4 = 0 THEN 'interest'
            WHEN l_orderkey % 12 = 1 THEN concat('BBPS-AB12-REF-NONE', {_s("l_orderkey")}, '-',
                                               {d.text("min(l_shipdate)", "ddMMyyyy")})
            ELSE concat('AB1-REF-KM', {_s("l_orderkey")}, '-',
                        {d.text("min(l_shipdate)", "MM/dd/yyyy")}) END AS Description,
       {d.text("min(l_shipdate)", "dd/MM/yyyy")} AS {d.name("Transaction Date")}
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


@view("bank_statement", "lineitem")
def _bank_statement(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN l_orderkey % 26 = 0 THEN concat('KMY', {_s("l_orderkey")})
            ELSE concat('KM', {_s("l_orderkey")}) END AS {d.name("Transaction Ref ID")},
       {_money("max(l_extendedprice)")} AS {d.name("Transaction Amount(RS.)")},
       CASE CAST(sum(l_linenumber) % 6 AS INT) WHEN 0 THEN 'Successful' WHEN 1 THEN 'Failure'
            WHEN 2 THEN 'Transaction Timed Out' WHEN 3 THEN NULL WHEN 4 THEN 'NA'
            ELSE 'Successful' END AS {d.name("NPCI Transaction Desc")},
       {d.text("max(l_shipdate)", "dd/MM/yyyy")} AS {d.name("Transaction Date")}
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


@view("premium_statement", "orders")
def _premium_statement(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN o_orderkey % 21 = 0 THEN ' NA ' WHEN o_orderkey % 25 = 0 THEN NULL
            WHEN o_orderkey % 22 = 0 THEN concat('Q', {_s("o_orderkey")})
            ELSE concat('P', {_s("o_orderkey")}) END AS IMWTID,
       CASE WHEN o_orderkey % 15 = 0 THEN 'bad' ELSE {_money("o_totalprice")} END AS Amount,
       {d.text("o_orderdate", "yyyy-MM-dd")} AS Date
FROM {d.table("orders")}"""


@view("premium_ledger", "orders")
def _premium_ledger(d: Dialect) -> str:
    return f"""
SELECT concat('P', {_s("o_orderkey")}) AS TID, CAST(NULL AS STRING) AS {d.name("Reference TID")},
       CASE WHEN o_orderkey % 4 = 0 THEN {_money("o_totalprice + 1")}
            ELSE {_money("o_totalprice")} END AS DR,
       CAST(NULL AS STRING) AS CR,
       {d.text("o_orderdate", "dd-MM-yyyy")} AS Date
FROM {d.table("orders")}
UNION ALL
SELECT concat('C', {_s("o_orderkey")}) AS TID,
       CASE WHEN o_orderkey % 6 = 0 THEN concat('U', {_s("o_orderkey")})
            ELSE concat(' P', {_s("o_orderkey")}) END AS {d.name("Reference TID")},
       CAST(NULL AS STRING) AS DR,
       CASE WHEN o_orderkey % 9 = 0 THEN '0' ELSE {_money("floor(o_totalprice / 100)")} END AS CR,
       {d.text("o_orderdate", "dd-MM-yyyy")} AS Date
FROM {d.table("orders")}"""


@view("card_ledger", "orders")
def _card_ledger(d: Dialect) -> str:
    return f"""
SELECT CASE WHEN o_orderkey % 20 = 0 THEN concat('X', {_s("o_orderkey")})
            ELSE concat('U', {_s("o_orderkey")}, ' ') END AS {d.name("Reference No")},
       {_money("o_totalprice")} AS {d.name("UTIITSL Amount")},
       {d.text("o_orderdate", "dd/MM/yyyy")} AS {d.name("Lot Date")}
FROM {d.table("orders")}"""


@view("card_statement", "lineitem")
def _card_statement(d: Dialect) -> str:
    return f"""
SELECT concat(' U', {_s("l_orderkey")}) AS {d.name("Reference No")},
       {_money("max(l_extendedprice)")} AS {d.name("Res Amount")},
       {d.text("min(l_shipdate)", "dd/MM/yyyy")} AS {d.name("Trans Date")},
       CASE CAST(sum(l_linenumber) % 5 AS INT)
            WHEN 0 THEN 'Payment Refunded due to Incomplete Application'
            WHEN 1 THEN NULL ELSE 'Paid' END AS {d.name("Payment Status")}
FROM {d.table("lineitem")} GROUP BY l_orderkey"""


@view("booking_statement", "orders")
def _booking_statement(d: Dialect) -> str:
    return f"""
SELECT concat('TK', {_s("o_orderkey")}) AS {d.name("Tkt. Number")},
       CASE WHEN o_orderkey % 71 = 0 THEN 'unknown'
            ELSE {d.text("o_orderdate", "dd-MM-yyyy HH:mm")} END AS {d.name("Booked Date")},
       CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN ' Failed' WHEN 1 THEN 'SUCCESS'
            WHEN 2 THEN 'pending' WHEN 3 THEN NULL ELSE 'success' END AS Status,
       CASE WHEN o_orderkey % 197 = 0 THEN 'abc' ELSE {_money("o_totalprice")} END
           AS {d.name("Ticket Amount")},
       {_money("floor(o_totalprice / 20)")} AS {d.name("Service Tax")},
       CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE {_money("floor(o_totalprice / 50)")} END
           AS {d.name("Comm.")},
       {_money("floor(o_totalprice / 500)")} AS {d.name("Comm TDS")}
FROM {d.table("orders")}"""


@view("booking_ledger", "orders", "lineitem")
def _booking_ledger(d: Dialect) -> str:
    # On two days in three the used amounts add up to the statement's net; ship
    # dates after the last order date give days that only the ledger has. A few entries
    # have a date or an amount that cannot be read.
    dec = "DECIMAL(18,2)"
    part = (
        f"(CAST(o_totalprice AS {dec}) + CAST(floor(o_totalprice / 20) AS {dec}))"
        f" - (CAST(floor(o_totalprice / 50) AS {dec}) - CAST(floor(o_totalprice / 500) AS {dec}))"
    )
    signed = f"""CASE WHEN o_orderkey % 71 = 0 OR o_orderkey % 83 = 0 OR o_orderkey % 197 = 0 THEN 0
            WHEN o_orderkey % 5 = 0 THEN -({part})
            WHEN o_orderkey % 5 = 1 OR o_orderkey % 5 = 4 THEN {part} ELSE 0 END"""
    day = d.text("o_orderdate", "dd-MM-yyyy")
    return f"""
SELECT {day} AS {d.name("Balance Date")},
       CASE WHEN CAST(max(day(o_orderdate)) AS INT) % 3 = 0 THEN CAST(sum({signed}) + 1 AS STRING)
            ELSE CAST(sum({signed}) AS STRING) END AS {d.name("Used Amount")}
FROM {d.table("orders")} GROUP BY {day}
UNION ALL
SELECT CASE WHEN l_suppkey % 9 = 4 THEN 'no date'
            ELSE {d.text("max(l_shipdate)", "dd-MM-yyyy")} END AS {d.name("Balance Date")},
       CASE WHEN l_suppkey % 11 = 5 THEN 'n/a'
            ELSE CAST(-CAST(count(*) AS DECIMAL(18,2)) AS STRING) END AS {d.name("Used Amount")}
FROM {d.table("lineitem")} GROUP BY l_suppkey"""


# ---------------------------------- ledgers and statements with unreadable values


def _soiled(name: str, base: str, columns: str, **changes: tuple[str, str]) -> None:
    """View ``soiled_<base>``: ``base`` with text instead of a value where a condition holds.

    ``columns``: all columns, separated by ``|``. ``changes``: by column, with underscores for
    what no argument name can have, the ending of ``name`` on which it changes, and the text put there.
    """

    def build(d: Dialect) -> str:
        shown = []
        for column in columns.split("|"):
            ending, text = changes.get("".join(c if c.isalnum() else "_" for c in column), (None, None))
            if ending is None:
                shown.append(d.name(column))
            else:
                key = f"trim({d.name(name)})"
                shown.append(
                    f"CASE WHEN {key} LIKE '%{ending}' THEN '{text}' ELSE {d.name(column)} END AS {d.name(column)}"
                )
        return f"SELECT {', '.join(shown)} FROM {d.table(base)}"

    VIEWS[f"soiled_{base}"] = View((base,), build)


_soiled(
    "TXNID",
    "refund_ledger",
    "TXNID|TYPE|AMOUNT|COMM/SHARE|TDS|DATE|REFID",
    AMOUNT=("13", "n/a"),
    COMM_SHARE=("3", "--"),
    DATE=("7", "31.31.2020"),
)
_soiled(
    "TXNID",
    "refund_statement",
    "TXNID|STATUS|AMOUNT|NET COMMISSION|TDS|DATE|REFID|REFUND",
    AMOUNT=("21", "1,250.00"),
    DATE=("9", "yesterday"),
)
_soiled(
    "SNO",
    "settlement_ledger",
    "SNO|TXNTYPE|Type |AMOUNT|DATE",
    AMOUNT=("14", "INR 5"),
    SNO=("77", "row 77"),
)
_soiled(
    "SERIALNUMBER",
    "settled_statement",
    "SETTLED_ID|AMOUNT|COMMISSION|STATUS|SERIALNUMBER|ACKNO|UTR",
    AMOUNT=("12.0", "void"),
    SETTLED_ID=("3.0", "12.5.0"),
)
_soiled(
    "Chq / Ref No.",
    "bank_ledger",
    "Chq / Ref No.|Debit|Credit|Description|Transaction Date",
    Debit=("5", "5 Dr"),
    Credit=("9", "refund"),
)
_soiled(
    "Transaction Ref ID",
    "bank_statement",
    "Transaction Ref ID|Transaction Amount(RS.)|NPCI Transaction Desc|Transaction Date",
    Transaction_Amount_RS__=("8", "error"),
)
_soiled(
    "TID",
    "premium_ledger",
    "TID|Reference TID|DR|CR|Date",
    DR=("6", "ten"),
    CR=("8", "ten"),
)
_soiled(
    "Reference No",
    "card_ledger",
    "Reference No|UTIITSL Amount|Lot Date",
    UTIITSL_Amount=("4", "107/-"),
)
_soiled(
    "Reference No",
    "card_statement",
    "Reference No|Res Amount|Trans Date|Payment Status",
    Res_Amount=("2", "unknown"),
)
