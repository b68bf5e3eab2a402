"""Two-sided match: buckets, counts, missing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.operators.match import duplicate_keys, outer_split
from tallybook.operators.columns import tagged, union_aligned
from tallybook.operators.rules import LEDGER_RULES, SETTLED
from tallybook.operators.summary import match_summary
from tallybook.plans import hub_recon
from tallybook.plans.result import Result

SIDES = ("hub", "vendor")
SHOWN = (
    "VENDOR_DATE",
    "TENANT_ID",
    "IHUB_REFERENCE",
    "REFID",
    "IHUB_USERNAME",
    "VENDOR_AMOUNT",
    "HUB_AMOUNT",
    "VENDOR_STATUS",
    "IHUB_MASTER_STATUS",
    "SERVICE_DATE",
    "IHUB_LEDGER_STATUS",
)

CASE = """CASE
  WHEN v = 'success' AND h = 'success' AND l = 'no' THEN 'VEND_IHUB_SUC-NIL'
  WHEN v = 'failed' AND h = 'success' AND l = 'no' THEN 'VEND_FAIL_IHUB_SUC-NIL'
  WHEN v = 'success' AND h = 'failed' AND l = 'no' THEN 'VEND_SUC_IHUB_FAIL-NIL'
  WHEN v IN ('failed','timed out') AND h = 'failed' AND l = 'no' THEN 'IHUB_FAIL_VEND_FAIL-NIL'
  WHEN v = 'success' AND h IN ('initiated','inprogress','pending') AND l = 'no' THEN 'IHUB_INT_VEND_SUC-NIL'
  WHEN v IN ('failed','timed out') AND h IN ('initiated','inprogress','pending') AND l = 'no' THEN 'VEND_FAIL_IHUB_INT-NIL'
  WHEN v = 'success' AND h = 'success' AND l = 'yes' THEN 'VEND_IHUB_SUC'
  WHEN v IN ('failed','timed out') AND h = 'failed' AND l = 'yes' THEN 'VEND_IHUB_FAIL'
  WHEN v IN ('failed','timed out') AND h = 'success' AND l = 'yes' THEN 'VEND_FAIL_IHUB_SUC'
  WHEN v = 'success' AND h = 'failed' AND l = 'yes' THEN 'VEND_SUC_IHUB_FAIL'
  WHEN v = 'success' AND h IN ('initiated','inprogress','pending') AND l = 'yes' THEN 'IHUB_INT_VEND_SUC'
  WHEN v IN ('failed','timed out') AND h IN ('initiated','inprogress','pending') AND l = 'yes' THEN 'VEND_FAIL_IHUB_INT'
  ELSE 'UNCLASSIFIED' END"""

NOT_IN_VENDOR = """NOT EXISTS (SELECT 1 FROM vendor v WHERE trim(v.REFID) = trim(h.VENDOR_REFERENCE)
  AND trim(v.REFID) <> '')"""
ON = {
    "reference": "h.VENDOR_REFERENCE = v.REFID",
    "strip": "trim(h.VENDOR_REFERENCE) = trim(v.REFID) AND trim(v.REFID) <> ''",
}


def parts_sql(mode: str) -> str:
    """CTEs ``pairs``, ``hub_only`` and ``vendor_only``."""
    return f"""
pairs AS (SELECT h.*, v.*, lower(trim(v.VENDOR_STATUS)) AS v, lower(trim(h.IHUB_MASTER_STATUS)) AS h,
                 lower(trim(h.IHUB_LEDGER_STATUS)) AS l
          FROM hub h JOIN vendor v ON {ON[mode]}),
hub_only AS (SELECT * FROM hub h WHERE {NOT_IN_VENDOR}),
vendor_only AS (SELECT * FROM vendor v WHERE NOT EXISTS (SELECT 1 FROM hub h WHERE {ON[mode]}))"""


def rows_sql(mode: str) -> str:
    return f"""WITH {parts_sql(mode)},
result AS (
SELECT {CASE} AS CATEGORY, VENDOR_DATE, TENANT_ID, IHUB_REFERENCE, REFID, IHUB_USERNAME,
       VENDOR_AMOUNT, HUB_AMOUNT, VENDOR_STATUS, IHUB_MASTER_STATUS, SERVICE_DATE, IHUB_LEDGER_STATUS
FROM pairs
UNION ALL
SELECT 'NOT_IN_VENDOR', NULL, TENANT_ID, IHUB_REFERENCE, VENDOR_REFERENCE, IHUB_USERNAME,
       NULL, HUB_AMOUNT, NULL, IHUB_MASTER_STATUS, SERVICE_DATE, IHUB_LEDGER_STATUS FROM hub_only
UNION ALL
SELECT 'NOT_IN_PORTAL', VENDOR_DATE, NULL, NULL, REFID, NULL,
       VENDOR_AMOUNT, NULL, VENDOR_STATUS, NULL, NULL, NULL FROM vendor_only)
"""


def counts_sql(mode: str) -> str:
    metrics = ["matched", "UNCLASSIFIED", *[r.category for r in LEDGER_RULES]]
    matched = "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, count(*) AS value FROM classified"
        + ("" if m == "matched" else f" WHERE category = '{m}'")
        for m in metrics
    )
    return f"""WITH {parts_sql(mode)},
classified AS (SELECT *, {CASE} AS category FROM pairs)
{matched}
UNION ALL SELECT 'Total_Success_count', count(*) FROM pairs WHERE v = 'success' AND h = 'success'
UNION ALL SELECT 'Total_Failed_count', count(*) FROM pairs WHERE v IN ('failed','timed out') AND h = 'failed'
UNION ALL SELECT 'HUB_Value_count', count(*) FROM hub
UNION ALL SELECT 'Excel_value_count', count(*) FROM vendor
UNION ALL SELECT 'Hub_initiated_count', count(*) FROM hub WHERE lower(IHUB_MASTER_STATUS) IN ('initiated','inprogress')
UNION ALL SELECT 'Hub_success_count', count(*) FROM hub WHERE lower(IHUB_MASTER_STATUS) = 'success'
UNION ALL SELECT 'Hub_failed_count', count(*) FROM hub WHERE lower(IHUB_MASTER_STATUS) = 'failed'
UNION ALL SELECT 'Vendor_success_count', count(*) FROM vendor WHERE lower(VENDOR_STATUS) = 'success'
UNION ALL SELECT 'Vendor_failed_count', count(*) FROM vendor WHERE lower(VENDOR_STATUS) = 'failed'
UNION ALL SELECT 'Vendor_timeout_count', count(*) FROM vendor WHERE lower(VENDOR_STATUS) = 'timed out'
UNION ALL SELECT 'NOT_IN_PORTAL', count(*) FROM vendor_only
UNION ALL SELECT 'NOT_IN_VENDOR', count(*) FROM hub_only"""


def bucket_rows(s: Source, mode: str) -> DataFrame:
    return hub_recon.buckets(s["hub"], s["vendor"], SHOWN, LEDGER_RULES, key_mode=mode)


@query(
    "recon_buckets",
    *SIDES,
    sql=rows_sql("reference") + "SELECT CATEGORY, count(*) AS n FROM result GROUP BY CATEGORY",
)
def recon_buckets(s: Source) -> DataFrame:
    return Result(bucket_rows(s, "reference"), s["hub"], SETTLED).sizes()


@query(
    "recon_buckets_stripped",
    *SIDES,
    sql=rows_sql("strip") + "SELECT CATEGORY, count(*) AS n FROM result GROUP BY CATEGORY",
)
def recon_buckets_stripped(s: Source) -> DataFrame:
    return Result(bucket_rows(s, "strip"), s["hub"], SETTLED).sizes()


@query("recon_rows", *SIDES, sql=rows_sql("reference") + "SELECT * FROM result")
def recon_rows(s: Source) -> DataFrame:
    return bucket_rows(s, "reference")


@query(
    "recon_combined",
    *SIDES,
    sql=rows_sql("strip")
    + "SELECT * FROM result WHERE CATEGORY NOT IN ('VEND_IHUB_SUC', 'VEND_IHUB_FAIL')",
)
def recon_combined(s: Source) -> DataFrame:
    return Result(bucket_rows(s, "strip"), s["hub"], SETTLED).combined()


@query("recon_counts", *SIDES, sql=counts_sql("reference"))
def recon_counts(s: Source) -> DataFrame:
    return match_summary(s["hub"], s["vendor"], LEDGER_RULES, key_mode="reference")


@query("recon_counts_stripped", *SIDES, sql=counts_sql("strip"))
def recon_counts_stripped(s: Source) -> DataFrame:
    return match_summary(s["hub"], s["vendor"], LEDGER_RULES, key_mode="strip")


@query(
    "recon_mismatched",
    *SIDES,
    sql=f"""WITH {parts_sql("strip")}
SELECT IHUB_REFERENCE, REFID, VENDOR_STATUS, IHUB_MASTER_STATUS FROM pairs
WHERE v IS NULL OR h IS NULL OR v <> h""",
)
def recon_mismatched(s: Source) -> DataFrame:
    matched = hub_recon.matched_rows(s["hub"], s["vendor"], LEDGER_RULES)
    return hub_recon.mismatched_rows(matched).select(
        "IHUB_REFERENCE", "REFID", "VENDOR_STATUS", "IHUB_MASTER_STATUS"
    )


@query(
    "recon_not_in_vendor",
    *SIDES,
    sql=f"SELECT * FROM hub h WHERE {NOT_IN_VENDOR}",
)
def recon_not_in_vendor(s: Source) -> DataFrame:
    return hub_recon.not_in_vendor(s["hub"], s["vendor"])


@query(
    "recon_not_in_portal",
    *SIDES,
    sql=f"""SELECT * FROM vendor v
WHERE NOT EXISTS (SELECT 1 FROM hub h WHERE {ON["reference"]})""",
)
def recon_not_in_portal(s: Source) -> DataFrame:
    return hub_recon.not_in_portal(s["hub"], s["vendor"], key_mode="reference")


@query(
    "outer_split",
    *SIDES,
    sql=f"""SELECT 'left_only' AS CATEGORY, trim(h.VENDOR_REFERENCE) AS KEY, h.IHUB_REFERENCE
FROM hub h WHERE {NOT_IN_VENDOR}
UNION ALL
SELECT 'right_only', trim(v.REFID), NULL FROM vendor v
WHERE NOT EXISTS (SELECT 1 FROM hub h WHERE {ON["strip"]})""",
)
def outer_split_query(s: Source) -> DataFrame:
    from tallybook.functions.text import strip

    left, right = outer_split(s["hub"], s["vendor"], "VENDOR_REFERENCE", "REFID")
    return union_aligned(
        tagged(
            left.select(strip("VENDOR_REFERENCE").alias("KEY"), "IHUB_REFERENCE"),
            "left_only",
        ),
        tagged(right.select(strip("REFID").alias("KEY")), "right_only"),
    )


@query(
    "duplicate_keys",
    "vendor",
    sql="""SELECT REFID, count(*) AS "rows" FROM vendor WHERE REFID IS NOT NULL
GROUP BY REFID HAVING count(*) > 1""",
)
def duplicate_keys_query(s: Source) -> DataFrame:
    return duplicate_keys(s["vendor"], "REFID")
