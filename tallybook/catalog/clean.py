"""Projection, cleaning, scalar functions, status rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.config.hub_services import BILL_ENTRY_CODES
from tallybook.config.vendor_files import VENDOR_FILES
from tallybook.functions import dates, labels, numbers, text
from tallybook.functions.status import KeepStatus
from tallybook.operators.columns import label_all, select_existing, upper_headers
from tallybook.plans.ledger_refunds import REFUND_DATE, REFUND_ID, STATUS_IN_TEXT
from tallybook.plans.ledger_bills import REFUND_DATE_LAYOUTS, REFUND_REFERENCE
from tallybook.plans.vendor_input import prepare_vendor, vendor_rejects
from tallybook.sources.sinks import presentable

NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


@query(
    "vendor_contract_rename",
    "vendor_file",
    sql="""SELECT "Transaction Ref ID" AS REFID,
  CAST(try_strptime("Transaction Date", '%d-%b-%Y %H:%M:%S') AS DATE) AS VENDOR_DATE,
  CASE "NPCI Transaction Desc" WHEN 'Successful' THEN 'success' WHEN 'Transaction timed out'
    THEN 'timed out' ELSE 'failed' END AS VENDOR_STATUS,
  TRY_CAST("Transaction Amount(RS.)" AS DOUBLE) AS VENDOR_AMOUNT,
  "NPCI Ref NO" AS "NPCI Ref NO", Remark
FROM vendor_file""",
)
def vendor_contract_rename(s: Source) -> DataFrame:
    return prepare_vendor(s["vendor_file"], "BBPS")


@query(
    "vendor_rejects",
    "vendor_file",
    sql="""SELECT "Transaction Ref ID" AS REFID,
  concat_ws(',', CASE WHEN TRY_CAST("Transaction Amount(RS.)" AS DOUBLE) IS NULL THEN 'amount' END,
    CASE WHEN try_strptime("Transaction Date", '%d-%b-%Y %H:%M:%S') IS NULL THEN 'date' END) AS REASON
FROM vendor_file
WHERE TRY_CAST("Transaction Amount(RS.)" AS DOUBLE) IS NULL
   OR try_strptime("Transaction Date", '%d-%b-%Y %H:%M:%S') IS NULL""",
)
def vendor_rejects_query(s: Source) -> DataFrame:
    return vendor_rejects(s["vendor_file"], "BBPS").select("REFID", "REASON")


@query(
    "header_normalise",
    "atm_ledger",
    sql="""SELECT UTR, Amount AS AMOUNT, "Cr/Dr" AS "CR/DR", Date AS DATE FROM atm_ledger""",
)
def header_normalise(s: Source) -> DataFrame:
    return upper_headers(s["atm_ledger"])


@query(
    "tolerant_select",
    "hub",
    sql="""SELECT IHUB_REFERENCE, HUB_AMOUNT, 'AUTO_CREDIT' AS MERGE_TYPE FROM hub""",
)
def tolerant_select(s: Source) -> DataFrame:
    picked = select_existing(s["hub"], ["IHUB_REFERENCE", "BBPS_CATEGORY", "HUB_AMOUNT"])
    return label_all(picked, MERGE_TYPE="AUTO_CREDIT")


@query(
    "clean_keys",
    "messy",
    sql=r"""SELECT id, trim(key_text) AS stripped,
  regexp_replace(trim(key_text), '\s+', ' ', 'g') AS squeezed,
  CASE WHEN trim(key_text) = '' THEN NULL ELSE trim(key_text) END AS key,
  substr(number_text, 1, 20) AS first_20, substr(number_text, 2, 10) AS from_2,
  CASE WHEN trim(key_text) IN ('None', 'nan', 'NULL') THEN NULL ELSE trim(key_text) END AS no_words
FROM messy""",
)
def clean_keys(s: Source) -> DataFrame:
    return s["messy"].select(
        "id",
        text.strip("key_text").alias("stripped"),
        text.squeeze("key_text").alias("squeezed"),
        text.key_of("key_text").alias("key"),
        text.char_slice("number_text", 1, 20).alias("first_20"),
        text.char_slice("number_text", 2, 10).alias("from_2"),
        text.null_words_to_null("key_text").alias("no_words"),
    )


@query(
    "numeric_text",
    "messy",
    sql=r"""SELECT id,
  CASE WHEN number_text IS NULL OR lower(trim(number_text)) = 'nan' THEN ''
       WHEN TRY_CAST(trim(number_text) AS DOUBLE) IS NOT NULL
         THEN CAST(CAST(trunc(CAST(trim(number_text) AS DOUBLE)) AS BIGINT) AS STRING)
       ELSE trim(number_text) END AS whole,
  regexp_replace(coalesce(number_text, ''), '\.0$', '') AS no_point_zero
FROM messy""",
)
def numeric_text(s: Source) -> DataFrame:
    return s["messy"].select(
        "id",
        numbers.whole_number_text("number_text").alias("whole"),
        text.drop_point_zero("number_text").alias("no_point_zero"),
    )


@query(
    "currency_clean",
    "messy",
    sql="""SELECT id, replace(replace(number_text, '₹', ''), ' ', '') AS amount FROM messy""",
)
def currency_clean(s: Source) -> DataFrame:
    return s["messy"].select("id", text.strip_currency("number_text").alias("amount"))


@query(
    "safe_numbers",
    "messy",
    sql=rf"""SELECT id,
  CASE WHEN regexp_matches(trim(number_text), '{NUMERIC}')
       THEN TRY_CAST(trim(number_text) AS DOUBLE) END AS number,
  coalesce(trim(number_text) <> '' AND NOT regexp_matches(trim(number_text), '{NUMERIC}'), FALSE)
    AS is_bad,
  CAST(TRY_CAST(amount_a AS DECIMAL(18,2)) + TRY_CAST(amount_b AS DECIMAL(18,2)) AS DOUBLE) AS total,
  CAST((TRY_CAST(amount_a AS DECIMAL(18,2)) + TRY_CAST(amount_b AS DECIMAL(18,2)))
     - (TRY_CAST(amount_b AS DECIMAL(18,2)) - TRY_CAST(amount_a AS DECIMAL(18,2))) AS DOUBLE) AS net
FROM messy""",
)
def safe_numbers(s: Source) -> DataFrame:
    a, b = numbers.to_decimal("amount_a"), numbers.to_decimal("amount_b")
    return s["messy"].select(
        "id",
        numbers.to_number("number_text").alias("number"),
        F.coalesce(numbers.is_bad_number("number_text"), F.lit(False)).alias("is_bad"),
        (a + b).cast("double").alias("total"),
        ((a + b) - (b - a)).cast("double").alias("net"),
    )


@query(
    "output_scrub_round",
    "messy",
    sql=rf"""SELECT id,
  CASE WHEN lower(trim(key_text)) IN ('nan', 'none', '') THEN NULL ELSE key_text END AS key_text,
  CASE WHEN number_text IS NULL THEN NULL
       WHEN regexp_matches(trim(number_text), '{NUMERIC}') THEN round(CAST(trim(number_text) AS DOUBLE), 3)
       ELSE 0.0 END AS AMOUNT,
  strftime(stamp, '%Y-%m-%d') AS stamp
FROM messy""",
)
def output_scrub_round(s: Source) -> DataFrame:
    rows = s["messy"].select("id", "key_text", F.col("number_text").alias("AMOUNT"), "stamp")
    return presentable(rows)


@query(
    "date_formats",
    "messy",
    sql="""SELECT id,
  CAST(coalesce(try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%d%m%Y')) AS DATE)
    AS refund_date,
  CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS iso_date,
  strftime(stamp, '%Y-%m-%d') AS day_text,
  split_part(date_text, '-', -1) AS last_part
FROM messy""",
)
def date_formats(s: Source) -> DataFrame:
    return s["messy"].select(
        "id",
        dates.parse_date("date_text", REFUND_DATE_LAYOUTS).alias("refund_date"),
        dates.parse_date("date_text", dates.ISO_LAYOUTS).alias("iso_date"),
        dates.date_text("stamp").alias("day_text"),
        text.last_token("date_text").alias("last_part"),
    )


@query(
    "timestamp_text",
    sql="""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp FROM events""",
)
def timestamp_text(s: Source) -> DataFrame:
    return s["events"].select("event_id", dates.micros_text("ts").alias("stamp"))


@query(
    "regex_refund",
    "messy",
    sql=r"""SELECT id,
  nullif(regexp_extract(note, 'Date :\s*(\d{4}-\d{2}-\d{2})', 1), '') AS refund_date,
  nullif(regexp_extract(note, 'Txnid(\d+)', 1), '') AS refund_id,
  nullif(regexp_extract(note, 'REF-([A-Z0-9]+)-', 1), '') AS refund_ref
FROM messy""",
)
def regex_refund(s: Source) -> DataFrame:
    return s["messy"].select(
        "id",
        text.capture("note", REFUND_DATE).alias("refund_date"),
        text.capture("note", REFUND_ID).alias("refund_id"),
        text.capture("note", REFUND_REFERENCE).alias("refund_ref"),
    )


@query(
    "code_label_map",
    "messy",
    "statuses",
    sql="""SELECT m.id, s.line,
  CASE code WHEN 0 THEN 'initiated' WHEN 1 THEN 'success' WHEN 2 THEN 'failed'
    WHEN 3 THEN 'inprogress' WHEN 4 THEN 'partial success' ELSE CAST(code AS STRING) END AS status,
  CASE tenant WHEN 1 THEN 'INET-CSC' WHEN 2 THEN 'ITI-ESEVA' WHEN 3 THEN 'UPCB'
    ELSE CAST(tenant AS STRING) END AS tenant,
  CASE word WHEN 'Successful' THEN '1' WHEN 'Transaction timed out' THEN '2' ELSE word END AS entry
FROM messy m JOIN statuses s ON m.id = s.id""",
)
def code_label_map(s: Source) -> DataFrame:
    both = s["messy"].join(s["statuses"], "id")
    return both.select(
        "id",
        "line",
        labels.label("code", labels.HUB_STATUS).alias("status"),
        labels.tenant_name("tenant").alias("tenant"),
        labels.label("word", BILL_ENTRY_CODES).alias("entry"),
    )


@query(
    "case_labels",
    "wallet",
    "users",
    sql="""SELECT w.MasterTransactionsId, w.ServiceName,
  coalesce(w.VendorReferenceId, w.IHubReferenceId) AS unique_reference,
  CASE WHEN w.VendorReferenceId IS NOT NULL THEN 'AUTO_CREDIT'
       WHEN w.IHubReferenceId IS NOT NULL THEN 'MANUAL_REFUND' ELSE 'UNKNOWN' END AS origin,
  CASE WHEN w.IHubReferenceId IS NOT NULL THEN 'Yes' ELSE 'No' END AS linked,
  CASE jansevaType WHEN 1 THEN 'Jenseva Kendra' WHEN 2 THEN 'Panchayat Sahayak' ELSE 'EBO' END
    AS centre
FROM wallet w LEFT JOIN users u ON u.id = w.MasterTransactionsId - 1000000000000""",
)
def case_labels(s: Source) -> DataFrame:
    users = s["users"].select("id", "jansevaType")
    rows = s["wallet"].join(
        users, F.col("id") == F.col("MasterTransactionsId") - F.lit(1000000000000), "left"
    )
    return rows.select(
        "MasterTransactionsId",
        "ServiceName",
        labels.first_present("VendorReferenceId", "IHubReferenceId").alias(
            "unique_reference"
        ),
        labels.credit_origin("VendorReferenceId", "IHubReferenceId").alias("origin"),
        labels.yes_no(F.col("IHubReferenceId").isNotNull()).alias("linked"),
        labels.centre_type("jansevaType").alias("centre"),
    )


AS_OF = "1998-06-15"


@query(
    "calendar_fields",
    sql="""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
  CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year,
  o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01' AS this_month,
  o_orderdate >= TIMESTAMP '1998-05-01' AND o_orderdate < TIMESTAMP '1998-06-01' AS last_month
FROM orders""",
)
def calendar_fields(s: Source) -> DataFrame:
    return s["orders"].select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.month("o_orderdate").alias("month"),
        F.year("o_orderdate").alias("year"),
        dates.in_month_of("o_orderdate", AS_OF).alias("this_month"),
        dates.in_month_before("o_orderdate", AS_OF).alias("last_month"),
    )


@query(
    "status_exact_map",
    "statuses",
    sql="""SELECT id, line,
  CASE word WHEN 'Successful' THEN 'success' WHEN 'Transaction timed out' THEN 'timed out'
    ELSE 'failed' END AS bill,
  CASE word WHEN 'Processed' THEN 'success' WHEN 'Rolled Back' THEN 'initiated' ELSE 'failed' END
    AS astro,
  CASE word WHEN 'Success' THEN 'success' ELSE 'failed' END AS transfer,
  CASE word WHEN 'PROCESSED' THEN 'success' ELSE 'failed' END AS bank
FROM statuses""",
)
def status_exact_map(s: Source) -> DataFrame:
    return s["statuses"].select(
        "id",
        "line",
        *[
            VENDOR_FILES[service].status.apply("word").alias(name)
            for service, name in (
                ("BBPS", "bill"),
                ("ASTRO", "astro"),
                ("DMT", "transfer"),
                ("MOVETOBANK", "bank"),
            )
        ],
    )


@query(
    "status_contains",
    "statuses",
    sql="""SELECT id, line,
  CASE WHEN lower(phrase) LIKE '%refunded%' THEN 'failed' ELSE 'success' END AS card,
  CASE WHEN lower(phrase) LIKE '%accepted%' THEN 'success' ELSE 'failed' END AS application,
  CASE WHEN lower(phrase) LIKE '%auth_success%' THEN 'success' ELSE 'failed' END AS atm,
  CASE WHEN lower(phrase) LIKE '%refunded%' THEN 'failed' ELSE 'success' END AS statement
FROM statuses""",
)
def status_contains(s: Source) -> DataFrame:
    return s["statuses"].select(
        "id",
        "line",
        VENDOR_FILES["PANUTI"].status.apply("phrase").alias("card"),
        VENDOR_FILES["PANNSDL"].status.apply("phrase").alias("application"),
        VENDOR_FILES["MATM"].status.apply("phrase").alias("atm"),
        STATUS_IN_TEXT.apply("phrase").alias("statement"),
    )


@query(
    "status_equals",
    "statuses",
    sql="""SELECT id, line,
  CASE WHEN lower(phrase) = 'authorised' THEN 'success' ELSE 'failed' END AS qr,
  trim(phrase) AS kept, phrase AS untouched
FROM statuses""",
)
def status_equals(s: Source) -> DataFrame:
    return s["statuses"].select(
        "id",
        "line",
        VENDOR_FILES["UPIQR"].status.apply("phrase").alias("qr"),
        KeepStatus().apply("phrase").alias("kept"),
        VENDOR_FILES["IMPS"].status.apply("phrase").alias("untouched"),
    )
