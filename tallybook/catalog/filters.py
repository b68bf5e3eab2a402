"""Windows, text filters, calendar filters and null-sensitive predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.clean import AS_OF
from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.functions import dates
from tallybook.functions.text import is_present, like_text
from tallybook.operators import filters
from tallybook.operators.summary import count_frame
from tallybook.plans.ledger_amounts import prepare_references
from tallybook.sources.tables import is_empty_window, named_query, rows_in_list

START, END = "1996-03-01", "1999-10-31"


@query(
    "window_closed_day",
    "master",
    sql=f"""SELECT Id, CreationTs FROM master
WHERE CAST(CreationTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'
  AND VendorSubServiceMappingId IN (1, 2, 3)""",
)
def window_closed_day(s: Source) -> DataFrame:
    inside = named_query(
        s.spark,
        """SELECT Id, CreationTs, VendorSubServiceMappingId FROM {master}
           WHERE CreationTs >= to_date(:first) AND CreationTs < date_add(to_date(:last), 1)""",
        {"master": s["master"]},
        first=START,
        last=END,
    )
    return rows_in_list(inside, "VendorSubServiceMappingId", [1, 2, 3]).select(
        "Id", "CreationTs"
    )


@query(
    "window_half_open",
    sql=f"""SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
)
def window_half_open(s: Source) -> DataFrame:
    return (
        s["events"]
        .where(dates.in_half_open("ts", "2024-01-05", "2024-01-21"))
        .select("event_id", "ts")
    )


@query(
    "window_lookahead",
    "wallet",
    sql=f"""SELECT 'closed' AS kind, ServiceName, count(*) AS n FROM wallet
WHERE CreationTs >= DATE '{START}' AND CreationTs <= DATE '{END}' + 30 GROUP BY ServiceName
UNION ALL
SELECT 'open', ServiceName, count(*) FROM wallet
WHERE CreationTs >= DATE '{START}' AND CreationTs < DATE '{END}' + 30 GROUP BY ServiceName""",
)
def window_lookahead(s: Source) -> DataFrame:
    def counted(kind: str, closed: bool) -> DataFrame:
        rows = s["wallet"].where(
            dates.in_lookahead("CreationTs", START, END, closed=closed)
        )
        return rows.groupBy(F.lit(kind).alias("kind"), "ServiceName").agg(
            F.count("*").alias("n")
        )

    return counted("closed", True).unionByName(counted("open", False))


@query(
    "window_guard",
    "vendor",
    sql=f"""SELECT REFID, VENDOR_DATE FROM vendor
WHERE EXISTS (SELECT 1 FROM vendor WHERE VENDOR_DATE BETWEEN DATE '{START}' AND DATE '{END}')""",
)
def window_guard(s: Source) -> DataFrame:
    rows = s["vendor"].select("REFID", "VENDOR_DATE")
    empty = is_empty_window(rows, dates.in_days("VENDOR_DATE", START, END))
    return rows.where(F.lit(not empty))


@query(
    "like_filters",
    "wallet",
    "users",
    sql="""SELECT 'wallet' AS kind, ServiceName AS name, count(*) AS n FROM wallet
WHERE ServiceName ILIKE '%UPI%' OR ServiceName ILIKE '%PASSPORT%' GROUP BY ServiceName
UNION ALL
SELECT 'user', UserName, count(*) FROM users
WHERE UserName ILIKE 'TN%' OR UserName ILIKE 'up01%' GROUP BY UserName
UNION ALL
SELECT 'exact', UserName, count(*) FROM users WHERE UserName LIKE 'TN%' GROUP BY UserName""",
)
def like_filters(s: Source) -> DataFrame:
    def counted(df: DataFrame, kind: str, name: str) -> DataFrame:
        return df.groupBy(F.lit(kind).alias("kind"), F.col(name).alias("name")).agg(
            F.count("*").alias("n")
        )

    wallet, users = s["wallet"], s["users"]
    upi = like_text("ServiceName", "%UPI%") | like_text("ServiceName", "%PASSPORT%")
    named = like_text("UserName", "TN%") | like_text("UserName", "up01%")
    upper = like_text("UserName", "TN%", case_sensitive=True)
    return (
        counted(wallet.where(upi), "wallet", "ServiceName")
        .unionByName(counted(users.where(named), "user", "UserName"))
        .unionByName(counted(users.where(upper), "exact", "UserName"))
    )


@query(
    "in_filters",
    "packages_bought",
    "portal_requests",
    sql="""SELECT 'package' AS kind, count(*) AS n FROM packages_bought WHERE PackageId IN (1, 4)
UNION ALL SELECT 'not_in', count(*) FROM packages_bought WHERE PackageId NOT IN (1)
UNION ALL SELECT 'code', count(*) FROM portal_requests WHERE service_code NOT ILIKE 'IS'""",
)
def in_filters(s: Source) -> DataFrame:
    packages = count_frame(
        s["packages_bought"],
        {
            "package": F.col("PackageId").isin(1, 4),
            "not_in": ~F.col("PackageId").isin(1),
        },
    )
    codes = count_frame(
        s["portal_requests"], {"code": ~like_text("service_code", "IS")}
    )
    return packages.unionByName(codes).withColumnsRenamed({"metric": "kind", "value": "n"})


@query(
    "all_null_drop",
    "wallet",
    sql="""SELECT MasterTransactionsId, IHubReferenceId, VendorReferenceId, count(*) AS n FROM wallet
WHERE NOT (MasterTransactionsId IS NULL AND VendorReferenceId IS NULL)
GROUP BY 1, 2, 3""",
)
def all_null_drop(s: Source) -> DataFrame:
    ids = s["wallet"].withColumn(
        "MASTER_TEXT", F.col("MasterTransactionsId").cast("string")
    )
    kept = filters.drop_all_null(ids, ["MASTER_TEXT", "VendorReferenceId"])
    # a list with an unknown column leaves the rows alone
    kept = filters.drop_all_null(kept, ["IHubReferenceId", "NO_SUCH_COLUMN"])
    return kept.groupBy(
        "MasterTransactionsId", "IHubReferenceId", "VendorReferenceId"
    ).agg(F.count("*").alias("n"))


@query(
    "regex_exclude_keep_null",
    "settlement_ledger",
    sql="""SELECT SNO, TXNTYPE FROM settlement_ledger
WHERE TXNTYPE IS NULL OR NOT regexp_matches(lower(TXNTYPE),
  'settlement|merchant two factor authentication charges|ministatement')""",
)
def regex_exclude_keep_null(s: Source) -> DataFrame:
    return filters.exclude_matching(
        s["settlement_ledger"], "TXNTYPE", filters.NON_TRANSACTION
    ).select("SNO", "TXNTYPE")


@query(
    "regex_status_null_true",
    "bank_statement",
    sql="""SELECT "Transaction Ref ID" AS ref, "NPCI Transaction Desc" AS status,
  coalesce(regexp_matches(trim(lower("NPCI Transaction Desc")),
    'failure|transaction timed out|^na$'), TRUE) AS looks_failed,
  coalesce(regexp_matches(lower("NPCI Transaction Desc"), 'failure|transaction timed out'), FALSE)
    AS says_failed
FROM bank_statement""",
)
def regex_status_null_true(s: Source) -> DataFrame:
    status = F.col("`NPCI Transaction Desc`")
    return s["bank_statement"].select(
        F.col("`Transaction Ref ID`").alias("ref"),
        status.alias("status"),
        filters.looks_failed(status).alias("looks_failed"),
        filters.says_failed(status).alias("says_failed"),
    )


@query(
    "ledger_text_filter",
    "bank_ledger",
    sql=r"""SELECT trim("Chq / Ref No.") AS ref, Description,
  coalesce(starts_with(trim("Chq / Ref No."), 'KM'), FALSE) AS is_bill,
  Credit IS NOT NULL AND coalesce(
    regexp_matches(Description, '^(BBPS-)?[A-Z]{2,3}\d{1,2}-REF-'), FALSE) AS is_refund
FROM bank_ledger""",
)
def ledger_text_filter(s: Source) -> DataFrame:
    ref = F.trim(F.col("`Chq / Ref No.`"))
    return s["bank_ledger"].select(
        ref.alias("ref"),
        "Description",
        filters.has_bill_prefix(ref).alias("is_bill"),
        filters.is_refund_entry("Credit", "Description").alias("is_refund"),
    )


@query(
    "calendar_filters",
    "packages_bought",
    sql=f"""SELECT 'after' AS metric, count(*) AS value FROM packages_bought
WHERE CAST(ExpireTs AS DATE) > DATE '{AS_OF}'
UNION ALL SELECT 'this_month', count(*) FROM packages_bought
WHERE month(ExpireTs) = 6 AND year(ExpireTs) = 1998
UNION ALL SELECT 'last_month', count(*) FROM packages_bought
WHERE ExpireTs >= TIMESTAMP '1998-05-01' AND ExpireTs < TIMESTAMP '1998-06-01'""",
)
def calendar_filters(s: Source) -> DataFrame:
    return count_frame(
        s["packages_bought"],
        {
            "after": dates.after_day("ExpireTs", AS_OF),
            "this_month": dates.in_month_of("ExpireTs", AS_OF),
            "last_month": dates.in_month_before("ExpireTs", AS_OF),
        },
    )


@query(
    "sentinel_year",
    "packages_bought",
    sql=f"""SELECT 'unset_or_from' AS metric, count(*) AS value FROM packages_bought
WHERE year(ExpireTs) = 1971 OR CAST(ExpireTs AS DATE) >= DATE '{START}'
UNION ALL SELECT 'unset_or_between', count(*) FROM packages_bought
WHERE year(ExpireTs) = 1971 OR CAST(ExpireTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'
UNION ALL SELECT 'set_and_between', count(*) FROM packages_bought
WHERE year(ExpireTs) <> 1971 AND CAST(ExpireTs AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'
UNION ALL SELECT 'set_and_before', count(*) FROM packages_bought
WHERE year(ExpireTs) <> 1971 AND CAST(ExpireTs AS DATE) < DATE '{START}'""",
)
def sentinel_year(s: Source) -> DataFrame:
    return count_frame(
        s["packages_bought"],
        {
            "unset_or_from": filters.unset_or_from("ExpireTs", START),
            "unset_or_between": filters.unset_or_between("ExpireTs", START, END),
            "set_and_between": filters.set_and_between("ExpireTs", START, END),
            "set_and_before": filters.set_and_before("ExpireTs", START),
        },
    )


@query(
    "nonblank_key",
    "transfer_table",
    sql="""SELECT utr_no, tot_amt FROM transfer_table WHERE utr_no IS NOT NULL AND trim(utr_no) <> ''""",
)
def nonblank_key(s: Source) -> DataFrame:
    return s["transfer_table"].where(is_present("utr_no")).select("utr_no", "tot_amt")


@query(
    "constant_split",
    "card_statement",
    sql="""SELECT trim("Reference No") AS ref,
  coalesce("Payment Status" = 'Payment Refunded due to Incomplete Application', FALSE) AS refunded
FROM card_statement""",
)
def constant_split(s: Source) -> DataFrame:
    _, clean, refunded = prepare_references(
        s["card_ledger"], s["card_statement"]
    )
    ref = F.col("STMT_REFERENCE_NO").alias("ref")
    return clean.select(ref, F.lit(False).alias("refunded")).unionByName(
        refunded.select(ref, F.lit(True).alias("refunded"))
    )


@query(
    "negative_credit_count",
    "booking_ledger",
    sql="""SELECT 'credit_count' AS metric, count(*) AS value FROM booking_ledger
WHERE TRY_CAST("Used Amount" AS DOUBLE) < 0""",
)
def negative_credit_count(s: Source) -> DataFrame:
    used = F.col("`Used Amount`").try_cast("decimal(18,2)")
    return count_frame(s["booking_ledger"], {"credit_count": used < 0})


@query(
    "placeholder_reference",
    "qr_payments",
    sql="""SELECT ReferenceNo, BankReferenceNo FROM qr_payments
WHERE (BankReferenceNo IS NULL OR trim(BankReferenceNo) IN ('0', 'None', 'nan', 'NULL'))
  AND ReferenceNo IS NOT NULL AND trim(ReferenceNo) NOT IN ('None', 'nan', 'NULL')""",
)
def placeholder_reference(s: Source) -> DataFrame:
    return (
        s["qr_payments"]
        .where(filters.reference_not_updated("BankReferenceNo", "ReferenceNo"))
        .select("ReferenceNo", "BankReferenceNo")
    )
