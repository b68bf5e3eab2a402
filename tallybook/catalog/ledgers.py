"""Vendor ledger against vendor statement: the steps and the whole reconciliations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.operators.filters import split_on
from tallybook.functions.numbers import amounts_equal
from tallybook.operators.match import exact, inner_match, missing_from
from tallybook.plans import (
    ledger_amounts,
    ledger_bills,
    ledger_commission,
    ledger_daily,
    ledger_refunds,
    ledger_settlement,
)
from tallybook.plans.ledger_recon import reconcile_ledger
from tallybook.plans.result import Result


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print amounts alike."""
    return df.select(
        *[
            F.col(f"`{n}`").cast("double").alias(n) if t.startswith("decimal") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def metrics(pairs: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST(({value}) AS BIGINT) AS value"
        for name, value in pairs.items()
    )


def count_of(table: str, where: str = "TRUE") -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


# ------------------------------------------------ refunds as separate rows

REFUND_VIEWS = ("refund_statement", "refund_ledger")
REFUND_SQL = r"""stm AS (SELECT TXNID, STATUS, AMOUNT, "NET COMMISSION" AS COMM, TDS,
  substr(DATE, 1, 10) AS DATE, trim(REFID) AS REFID,
  nullif(regexp_extract(REFUND, 'Date :\s*(\d{4}-\d{2}-\d{2})', 1), '') AS REFUNDED_DATE,
  nullif(regexp_extract(REFUND, 'Txnid(\d+)', 1), '') AS REFUND_TXNID FROM refund_statement),
led AS (SELECT TXNID, TYPE, AMOUNT, "COMM/SHARE" AS COMM, TDS, DATE, REFID FROM refund_ledger)"""
COLUMN_REFUND_SQL = """stm AS (SELECT TXNID,
  CASE WHEN lower(STATUS) LIKE '%refunded%' THEN 'failed' ELSE 'success' END AS STATUS, AMOUNT, COMM,
  TDS, DATE, REFID, substr(REFUND, 8, 10) AS REFUNDED_DATE, trim(REFUNDTXNID) AS REFUND_TXNID
  FROM column_refund_statement),
led AS (SELECT TXNID, TYPE, AMOUNT, "COMM/SHARE" AS COMM, TDS, DATE, REFID FROM refund_ledger)"""
REFUND_PARTS = """failed AS (SELECT * FROM stm WHERE lower(trim(STATUS)) = 'failed'),
refund_rows AS (SELECT * FROM led l WHERE NOT EXISTS
  (SELECT 1 FROM stm s WHERE trim(s.TXNID) = trim(l.TXNID))),
matched AS (SELECT s.*, l.TYPE FROM stm s JOIN led l ON trim(s.TXNID) = trim(l.TXNID))"""
REFUND_ROWS = """
SELECT 'matching_trans' AS CATEGORY, TXNID, AMOUNT, COMM, TDS, TYPE, DATE, REFID, STATUS,
  REFUND_TXNID, REFUNDED_DATE FROM matched WHERE STATUS IS NULL OR STATUS <> 'failed'
UNION ALL
SELECT 'not_in_ledger', TXNID, AMOUNT, COMM, TDS, NULL, DATE, REFID, STATUS, REFUND_TXNID, REFUNDED_DATE
FROM stm s WHERE NOT EXISTS (SELECT 1 FROM led l WHERE trim(l.TXNID) = trim(s.TXNID))
UNION ALL
SELECT 'matching_refunds', f.TXNID, f.AMOUNT, f.COMM, f.TDS, r.TYPE, f.DATE, f.REFID, f.STATUS,
  f.REFUND_TXNID, f.REFUNDED_DATE FROM failed f JOIN refund_rows r ON trim(r.TXNID) = f.REFUND_TXNID
UNION ALL
SELECT 'failed_not_refunded', TXNID, AMOUNT, COMM, TDS, NULL, DATE, REFID, STATUS, REFUND_TXNID,
  REFUNDED_DATE FROM failed f
WHERE NOT EXISTS (SELECT 1 FROM refund_rows r WHERE trim(r.TXNID) = f.REFUND_TXNID)
UNION ALL
SELECT 'not_in_statement', TXNID, AMOUNT, COMM, TDS, TYPE, DATE, REFID, NULL, NULL, NULL
FROM refund_rows r WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.REFUND_TXNID = trim(r.TXNID))"""


@query(
    "refund_reconcile",
    *REFUND_VIEWS,
    sql=f"WITH {REFUND_SQL},\n{REFUND_PARTS}{REFUND_ROWS}",
)
def refund_reconcile(s: Source) -> DataFrame:
    return reconcile_ledger(
        "RECHARGE", s["refund_ledger"], s["refund_statement"]
    ).buckets


@query(
    "refund_reconcile_column",
    "column_refund_statement",
    "refund_ledger",
    sql=f"WITH {COLUMN_REFUND_SQL},\n{REFUND_PARTS}{REFUND_ROWS}",
)
def refund_reconcile_column(s: Source) -> DataFrame:
    return reconcile_ledger(
        "DMT", s["refund_ledger"], s["column_refund_statement"]
    ).buckets


@query(
    "refund_counts",
    *REFUND_VIEWS,
    sql=f"WITH {REFUND_SQL},\n{REFUND_PARTS}\n"
    + metrics(
        {
            "ledger_count": count_of("led"),
            "ledger_credit_count": count_of("led", "lower(trim(TYPE)) = 'credit'"),
            "statement_count": count_of("stm"),
            "failed_trans_count": count_of("failed"),
            "matched_trans_count": count_of("matched"),
            "matching_trans_count": count_of(
                "matched", "STATUS IS NULL OR STATUS <> 'failed'"
            ),
        }
    ),
)
def refund_counts(s: Source) -> DataFrame:
    return reconcile_ledger(
        "RECHARGE", s["refund_ledger"], s["refund_statement"]
    ).counts


@query(
    "refund_linked",
    *REFUND_VIEWS,
    sql=f"""WITH {REFUND_SQL},\n{REFUND_PARTS}
SELECT f.TXNID, f.REFUND_TXNID, r.AMOUNT AS REFUND_AMOUNT, r.DATE AS REFUND_DATE
FROM failed f JOIN refund_rows r ON trim(r.TXNID) = f.REFUND_TXNID""",
)
def refund_linked(s: Source) -> DataFrame:
    led, stm = ledger_refunds.prepare(s["refund_ledger"], s["refund_statement"], False)
    ledger_only = missing_from(led, stm, "TXNID", "TXNID")
    links = ledger_refunds.refund_links(stm.where(ledger_refunds.is_failed()), ledger_only)
    return links.select(
        "TXNID",
        "REFUND_TXNID",
        F.col("L_AMOUNT").alias("REFUND_AMOUNT"),
        F.col("L_DATE").alias("REFUND_DATE"),
    )


@query(
    "refund_unlinked",
    *REFUND_VIEWS,
    sql=f"""WITH {REFUND_SQL},\n{REFUND_PARTS}
SELECT TXNID, REFUND_TXNID, TDS, REFUNDED_DATE FROM failed f
WHERE NOT EXISTS (SELECT 1 FROM refund_rows r WHERE trim(r.TXNID) = f.REFUND_TXNID)""",
)
def refund_unlinked(s: Source) -> DataFrame:
    result = reconcile_ledger("RECHARGE", s["refund_ledger"], s["refund_statement"])
    return result.bucket("failed_not_refunded").select(
        "TXNID", "REFUND_TXNID", "TDS", "REFUNDED_DATE"
    )


# ---------------------------------------------- settlements and commission

SETTLED_VIEWS = ("settled_statement", "settlement_ledger")
SETTLED_SQL = r"""stm AS (SELECT TRY_CAST(regexp_replace(SETTLED_ID, '\.0$', '') AS BIGINT) AS SETTLED_ID,
  CAST(AMOUNT AS DECIMAL(38,18)) AS AMOUNT, COMMISSION, STATUS,
  regexp_replace(coalesce(SERIALNUMBER, ''), '\.0$', '') AS SERIALNUMBER,
  coalesce(ACKNO, '') AS ACKNO, regexp_replace(coalesce(UTR, ''), '\.0$', '') AS UTR
  FROM settled_statement),
led AS (SELECT CAST(SNO AS BIGINT) AS SNO, TXNTYPE, "Type " AS TYPE, CAST(AMOUNT AS DECIMAL(38,18)) AS AMOUNT, DATE
  FROM settlement_ledger WHERE TXNTYPE IS NULL OR NOT regexp_matches(lower(TXNTYPE),
    'settlement|merchant two factor authentication charges|ministatement')),
compared AS (SELECT t.SETTLED_ID, t.total, l.* FROM (SELECT SETTLED_ID, coalesce(sum(AMOUNT), 0) AS total
  FROM stm WHERE SETTLED_ID IS NOT NULL GROUP BY SETTLED_ID) t JOIN led l ON l.SNO = t.SETTLED_ID),
idle AS (SELECT * FROM led WHERE SNO NOT IN (SELECT SETTLED_ID FROM stm WHERE SETTLED_ID IS NOT NULL)),
agreed AS (SELECT * FROM compared WHERE total = AMOUNT),
commission AS (SELECT * FROM idle WHERE SNO IN (SELECT SNO + 1 FROM agreed)),
detail AS (SELECT a.SNO, a.TYPE, a.DATE, a.AMOUNT AS AMOUNT_LEDGER, s.* FROM agreed a
  JOIN stm s ON s.SETTLED_ID = a.SETTLED_ID)"""

UNKNOWN_SETTLEMENT = """(SETTLED_ID IS NULL OR SETTLED_ID NOT IN (SELECT SNO FROM led))
  AND (STATUS IS NULL OR lower(STATUS) <> 'failed')"""


@query(
    "settlement_reconcile",
    *SETTLED_VIEWS,
    sql=f"""WITH {SETTLED_SQL}
SELECT 'matching_trans' AS CATEGORY, d.SETTLED_ID, c.SNO AS COMMISSION_SNO, d.SERIALNUMBER, d.ACKNO,
  d.UTR, CAST(d.AMOUNT_LEDGER AS DOUBLE) AS AMOUNT_LEDGER, CAST(d.AMOUNT AS DOUBLE) AS AMOUNT_STATEMENT,
  d.COMMISSION AS COMMISSION_STATEMENT, c.TYPE, d.STATUS, c.DATE, CAST(NULL AS DOUBLE) AS SUM_AMOUNT
FROM detail d JOIN commission c ON c.SNO = d.SNO + 1
UNION ALL
SELECT 'MATCHED_NO_COMMISSION', SETTLED_ID, NULL, SERIALNUMBER, ACKNO, UTR, AMOUNT_LEDGER, AMOUNT,
  COMMISSION, TYPE, STATUS, DATE, NULL FROM detail
WHERE SNO + 1 NOT IN (SELECT SNO FROM commission)
UNION ALL
SELECT 'amount_mismatch', SETTLED_ID, NULL, NULL, NULL, NULL, AMOUNT, NULL, NULL, TYPE, NULL, DATE, total
FROM compared WHERE total <> AMOUNT
UNION ALL
SELECT 'not_in_statement', SNO, NULL, NULL, NULL, NULL, AMOUNT, NULL, NULL, TYPE, NULL, DATE, NULL
FROM idle WHERE SNO NOT IN (SELECT SNO FROM commission)
UNION ALL
SELECT 'not_in_ledger', SETTLED_ID, NULL, SERIALNUMBER, ACKNO, UTR, NULL, AMOUNT, COMMISSION, NULL,
  STATUS, NULL, NULL FROM stm
WHERE {UNKNOWN_SETTLEMENT}""",
)
def settlement_reconcile(s: Source) -> DataFrame:
    return plain(
        reconcile_ledger(
            "AEPS", s["settlement_ledger"], s["settled_statement"]
        ).buckets
    )


@query(
    "settlement_counts",
    *SETTLED_VIEWS,
    sql=f"WITH {SETTLED_SQL}\n"
    + metrics(
        {
            "ledger_count": count_of("settlement_ledger"),
            "statement_count": count_of("settled_statement"),
            "ledger_credit_count": count_of("led", "lower(trim(TYPE)) = 'credit'"),
            "matched_trans_count": count_of(
                "detail d", "EXISTS (SELECT 1 FROM commission c WHERE c.SNO = d.SNO + 1)"
            ),
            "failed_trans_count": f"""SELECT ({count_of("idle", "SNO NOT IN (SELECT SNO FROM commission)")})
  + ({count_of("stm", UNKNOWN_SETTLEMENT)})""",
        }
    ),
)
def settlement_counts(s: Source) -> DataFrame:
    return reconcile_ledger(
        "AEPS", s["settlement_ledger"], s["settled_statement"]
    ).counts


@query(
    "group_total_vs_ledger",
    *SETTLED_VIEWS,
    sql=f"""WITH {SETTLED_SQL}
SELECT SETTLED_ID, CAST(total AS DOUBLE) AS SUM_AMOUNT, CAST(AMOUNT AS DOUBLE) AS AMOUNT_LEDGER,
  total = AMOUNT AS AGREES FROM compared""",
)
def group_total_vs_ledger(s: Source) -> DataFrame:
    led, stm = ledger_settlement.prepare(s["settlement_ledger"], s["settled_statement"])
    settled = ledger_settlement.compare_totals(led, stm).where(
        ~ledger_settlement.is_idle()
    )
    return plain(
        settled.select(
            F.col("SNO").alias("SETTLED_ID"), "SUM_AMOUNT", "AMOUNT_LEDGER", "AGREES"
        )
    )


@query(
    "seq_adjacent_commission",
    *SETTLED_VIEWS,
    sql=f"""WITH {SETTLED_SQL}
SELECT 'commission' AS CATEGORY, SNO, CAST(AMOUNT AS DOUBLE) AS AMOUNT FROM commission
UNION ALL SELECT 'other', SNO, AMOUNT FROM idle WHERE SNO NOT IN (SELECT SNO FROM commission)""",
)
def seq_adjacent_commission(s: Source) -> DataFrame:
    led, stm = ledger_settlement.prepare(s["settlement_ledger"], s["settled_statement"])
    marked = ledger_settlement.mark_commission(ledger_settlement.compare_totals(led, stm))
    kind = F.when(F.col("IS_COMMISSION"), F.lit("commission")).otherwise(F.lit("other"))
    return plain(
        marked.where(ledger_settlement.is_idle()).select(
            kind.alias("CATEGORY"), "SNO", F.col("AMOUNT_LEDGER").alias("AMOUNT")
        )
    )


# ----------------------------------------------- amounts on one reference

ATM_VIEWS = ("atm_ledger", "atm_statement")


def _whole(expr: str) -> str:
    return f"""CASE WHEN {expr} IS NULL OR lower(trim({expr})) = 'nan' THEN ''
  WHEN TRY_CAST(trim({expr}) AS DOUBLE) IS NOT NULL
    THEN CAST(CAST(trunc(CAST(trim({expr}) AS DOUBLE)) AS BIGINT) AS STRING)
  ELSE trim({expr}) END"""


ATM_SQL = f"""led AS (SELECT trim(UTR) AS UTR,
  {_whole("replace(replace(Amount, '₹', ''), ' ', '')")} AS AMOUNT_LEDGER,
  "Cr/Dr" AS side, Date AS DATE FROM atm_ledger),
stm AS (SELECT * FROM (SELECT {_whole("RRN")} AS RRN, {_whole("Amount")} AS AMOUNT_STATEMENT,
  bcid AS BCID, TransactionStatus AS TRANSACTIONSTATUS FROM atm_statement) t WHERE RRN <> ''),
both_sides AS (SELECT * FROM led JOIN stm ON UTR = RRN)"""
ATM_ROWS = """
SELECT CASE WHEN AMOUNT_LEDGER = AMOUNT_STATEMENT THEN 'matching_trans' ELSE 'amount_mismatch' END
  AS CATEGORY, BCID, AMOUNT_STATEMENT, AMOUNT_LEDGER, RRN, TRANSACTIONSTATUS, DATE FROM both_sides
UNION ALL SELECT 'not_in_statement', NULL, NULL, AMOUNT_LEDGER, UTR, NULL, DATE FROM led l
WHERE NOT EXISTS (SELECT 1 FROM stm WHERE RRN = l.UTR)
UNION ALL SELECT 'not_in_ledger', BCID, AMOUNT_STATEMENT, NULL, RRN, TRANSACTIONSTATUS, NULL FROM stm s
WHERE NOT EXISTS (SELECT 1 FROM led WHERE UTR = s.RRN)"""


@query("amount_reconcile", *ATM_VIEWS, sql=f"WITH {ATM_SQL}{ATM_ROWS}")
def amount_reconcile(s: Source) -> DataFrame:
    return reconcile_ledger("MATM", s["atm_ledger"], s["atm_statement"]).buckets


@query(
    "amount_counts",
    *ATM_VIEWS,
    sql=f"WITH {ATM_SQL}, result AS ({ATM_ROWS})\n"
    + metrics(
        {
            "ledger_count": count_of("led"),
            "ledger_credit_count": count_of("led", "lower(trim(side)) = 'cr'"),
            "statement_count": count_of("atm_statement"),
            "matched_trans_count": count_of("result", "CATEGORY = 'matching_trans'"),
            "failed_trans_count": count_of(
                "result", "CATEGORY IN ('not_in_statement', 'not_in_ledger')"
            ),
        }
    ),
)
def amount_counts(s: Source) -> DataFrame:
    return reconcile_ledger("MATM", s["atm_ledger"], s["atm_statement"]).counts


@query(
    "amount_match_split",
    *ATM_VIEWS,
    sql=f"""WITH {ATM_SQL}, exact AS (SELECT *, TRY_CAST(replace(replace(a.Amount, '₹', ''), ' ', '') AS DECIMAL(38,18)) AS x,
  TRY_CAST(b.Amount AS DECIMAL(38,18)) AS y FROM (SELECT trim(UTR) AS k, Amount FROM atm_ledger) a
  JOIN (SELECT {_whole("RRN")} AS RRN, Amount FROM atm_statement) b ON a.k = b.RRN WHERE RRN <> '')
SELECT RRN, CAST(x AS DOUBLE) AS AMOUNT_LEDGER, CAST(y AS DOUBLE) AS AMOUNT_STATEMENT,
  coalesce(x = y, FALSE) AS AGREES FROM exact""",
)
def amount_match_split(s: Source) -> DataFrame:
    led, stm = ledger_amounts.prepare_amounts(
        s["atm_ledger"], s["atm_statement"], amount_mode="exact"
    )
    both = inner_match(led, stm, "UTR", "RRN", exact)
    equal, unequal = split_on(both, amounts_equal("AMOUNT_LEDGER", "AMOUNT_STATEMENT"))
    rows = equal.withColumn("AGREES", F.lit(True)).unionByName(
        unequal.withColumn("AGREES", F.lit(False))
    )
    return plain(rows.select("RRN", "AMOUNT_LEDGER", "AMOUNT_STATEMENT", "AGREES"))


CARD_VIEWS = ("card_ledger", "card_statement")
CARD_SQL = """led AS (SELECT trim("Reference No") AS LDG_REFERENCE_NO, "UTIITSL Amount" AS AMOUNT_LEDGER,
  "Lot Date" AS LEDGER_DATE FROM card_ledger),
stm AS (SELECT trim("Reference No") AS STMT_REFERENCE_NO, "Res Amount" AS AMOUNT_STATEMENT,
  "Trans Date" AS STATEMENT_DATE FROM card_statement WHERE "Payment Status" IS NULL
  OR "Payment Status" <> 'Payment Refunded due to Incomplete Application')"""
CARD_ROWS = """
SELECT 'matching_trans' AS CATEGORY, * FROM led JOIN stm ON LDG_REFERENCE_NO = STMT_REFERENCE_NO
UNION ALL SELECT 'not_in_statement', *, NULL, NULL, NULL FROM led
WHERE NOT EXISTS (SELECT 1 FROM stm WHERE LDG_REFERENCE_NO = STMT_REFERENCE_NO)
UNION ALL SELECT 'not_in_ledger', NULL, NULL, NULL, * FROM stm
WHERE NOT EXISTS (SELECT 1 FROM led WHERE LDG_REFERENCE_NO = STMT_REFERENCE_NO)"""


@query("ledger_statement_missing", *CARD_VIEWS, sql=f"WITH {CARD_SQL}{CARD_ROWS}")
def ledger_statement_missing(s: Source) -> DataFrame:
    return reconcile_ledger("PANUTI", s["card_ledger"], s["card_statement"]).buckets


@query(
    "reference_counts",
    *CARD_VIEWS,
    sql=f"WITH {CARD_SQL}, result AS ({CARD_ROWS})\n"
    + metrics(
        {
            "ledger_count": count_of("card_ledger"),
            "statement_count": count_of("card_statement"),
            "matched_trans_count": count_of("result", "CATEGORY = 'matching_trans'"),
            "failed_trans_count": f"""SELECT ({count_of("result", "CATEGORY <> 'matching_trans'")})
  + ({count_of("card_statement", '"Payment Status" = ' + "'Payment Refunded due to Incomplete Application'")})""",
        }
    ),
)
def reference_counts(s: Source) -> DataFrame:
    return reconcile_ledger("PANUTI", s["card_ledger"], s["card_statement"]).counts


# ------------------------------------------------- bank ledger and refunds

BANK_VIEWS = ("bank_ledger", "bank_statement")
BANK_SQL = rf"""led AS (SELECT trim("Chq / Ref No.") AS ref, {_whole("Debit")} AS AMOUNT_LEDGER,
  trim(Credit) AS Credit, trim(Description) AS Description, "Transaction Date" AS led_date FROM bank_ledger),
stm AS (SELECT trim("Transaction Ref ID") AS sref, {_whole('"Transaction Amount(RS.)"')} AS AMOUNT_STATEMENT,
  trim("NPCI Transaction Desc") AS TRANSACTION_STATUS, "Transaction Date" AS stm_date FROM bank_statement),
refunds AS (SELECT nullif(regexp_extract(Description, 'REF-([A-Z0-9]+)-', 1), '') AS rref,
  TRY_CAST(Credit AS DOUBLE) AS REFUNDED_AMOUNT, led_date,
  strftime(CAST(coalesce(try_strptime(split_part(Description, '-', -1), '%m/%d/%Y'),
    try_strptime(split_part(Description, '-', -1), '%d%m%Y')) AS DATE), '%Y-%m-%d') AS ACTUAL_TRANS_DATE
  FROM led WHERE Credit IS NOT NULL
    AND regexp_matches(Description, '^(BBPS-)?[A-Z]{{2,3}}\d{{1,2}}-REF-')),
both_sides AS (SELECT ref, AMOUNT_LEDGER, led_date, stm.* FROM led JOIN stm ON ref = sref),
equal AS (SELECT *, row_number() OVER () AS rid, coalesce(regexp_matches(lower(TRANSACTION_STATUS),
    'failure|transaction timed out|^na$'), TRUE) AS looks_failed,
  coalesce(regexp_matches(lower(TRANSACTION_STATUS), 'failure|transaction timed out'), FALSE) AS says_failed
  FROM both_sides WHERE AMOUNT_LEDGER = AMOUNT_STATEMENT),
checked AS (SELECT e.*, r.REFUNDED_AMOUNT,
  coalesce(r.REFUNDED_AMOUNT = CAST(AMOUNT_STATEMENT AS DOUBLE), FALSE) AS agrees
  FROM equal e JOIN refunds r ON r.rref = e.ref WHERE looks_failed),
with_refund AS (SELECT e.*, c.REFUNDED_AMOUNT FROM equal e
  LEFT JOIN (SELECT rid, REFUNDED_AMOUNT FROM checked WHERE agrees) c ON c.rid = e.rid)"""
BANK_ROWS = """
SELECT CASE WHEN says_failed AND REFUNDED_AMOUNT IS NULL THEN 'failed_not_refunded'
    ELSE 'matching_trans' END AS CATEGORY, ref AS TRANS_REF_ID, AMOUNT_LEDGER, AMOUNT_STATEMENT,
  REFUNDED_AMOUNT, TRANSACTION_STATUS, CAST(NULL AS STRING) AS ACTUAL_TRANS_DATE, led_date AS DATE
FROM with_refund
UNION ALL SELECT 'amount_mismatch', ref, AMOUNT_LEDGER, AMOUNT_STATEMENT, NULL, TRANSACTION_STATUS, NULL,
  led_date FROM both_sides WHERE AMOUNT_LEDGER <> AMOUNT_STATEMENT
UNION ALL SELECT 'not_in_statement', ref, AMOUNT_LEDGER, NULL, NULL, NULL, NULL, led_date FROM led
WHERE starts_with(ref, 'KM') AND ref NOT IN (SELECT sref FROM stm)
UNION ALL SELECT 'not_in_ledger', sref, NULL, AMOUNT_STATEMENT, NULL, TRANSACTION_STATUS, NULL, stm_date
FROM stm WHERE NOT EXISTS (SELECT 1 FROM led WHERE ref = sref)
UNION ALL SELECT 'refund_amount_mismatch', ref, AMOUNT_LEDGER, AMOUNT_STATEMENT, REFUNDED_AMOUNT,
  TRANSACTION_STATUS, NULL, led_date FROM checked WHERE NOT agrees
UNION ALL SELECT 'Credit_Trans_in_Ledger_not_in_Stmnt', rref, NULL, NULL, REFUNDED_AMOUNT, NULL,
  ACTUAL_TRANS_DATE, led_date FROM refunds WHERE NOT EXISTS (SELECT 1 FROM stm WHERE sref = rref)"""


@query("bill_reconcile", *BANK_VIEWS, sql=f"WITH {BANK_SQL}{BANK_ROWS}")
def bill_reconcile(s: Source) -> DataFrame:
    return reconcile_ledger("BBPS", s["bank_ledger"], s["bank_statement"]).buckets


@query(
    "bill_counts",
    *BANK_VIEWS,
    sql=f"WITH {BANK_SQL}, result AS ({BANK_ROWS})\n"
    + metrics(
        {
            "ledger_count": count_of("led"),
            "ledger_credit_count": count_of("led", "Credit IS NOT NULL"),
            "statement_count": count_of("stm"),
            "matched_trans_count": count_of("equal"),
            "failed_trans_count": count_of(
                "result",
                "CATEGORY IN ('not_in_statement', 'not_in_ledger', 'amount_mismatch', "
                "'refund_amount_mismatch')",
            ),
        }
    ),
)
def bill_counts(s: Source) -> DataFrame:
    return reconcile_ledger("BBPS", s["bank_ledger"], s["bank_statement"]).counts


@query(
    "refund_amount_check",
    *BANK_VIEWS,
    sql=f"""WITH {BANK_SQL}
SELECT ref, AMOUNT_STATEMENT, REFUNDED_AMOUNT, agrees AS REFUND_AGREES FROM checked""",
)
def refund_amount_check(s: Source) -> DataFrame:
    led, stm = ledger_bills.prepare(s["bank_ledger"], s["bank_statement"])
    both = inner_match(
        led.drop("CREDIT", "DESCRIPTION"), stm, "LEDGER_REF", "STATEMENT_REF", exact
    )
    failed = both.where(
        amounts_equal("AMOUNT_LEDGER", "AMOUNT_STATEMENT")
        & ledger_bills.looks_failed("TRANSACTION_STATUS")
    )
    return ledger_bills.refund_amount_check(
        failed, ledger_bills.refund_entries(led)
    ).select(
        F.col("LEDGER_REF").alias("ref"),
        "AMOUNT_STATEMENT",
        "REFUNDED_AMOUNT",
        "REFUND_AGREES",
    )


# -------------------------------------------- commission rows by reference

PREMIUM_VIEWS = ("premium_ledger", "premium_statement")
PREMIUM_SQL = """led AS (SELECT nullif(trim(TID), '') AS tid, nullif(trim("Reference TID"), '') AS parent,
  TRY_CAST(trim(DR) AS DECIMAL(38,18)) AS amt, TRY_CAST(trim(CR) AS DECIMAL(38,18)) AS comm, Date AS d
  FROM premium_ledger),
stm AS (SELECT nullif(trim(IMWTID), 'NA') AS stid, TRY_CAST(trim(Amount) AS DECIMAL(38,18)) AS samt, Date AS sd
  FROM premium_statement),
both_sides AS (SELECT *, coalesce(amt = samt, FALSE) AS agrees FROM led JOIN stm ON tid = stid),
ledger_only AS (SELECT * FROM led WHERE NOT EXISTS (SELECT 1 FROM stm WHERE stid = tid)),
paired AS (SELECT b.*, c.tid AS ctid, c.comm AS ccomm FROM both_sides b
  JOIN ledger_only c ON c.parent = b.tid)"""
PREMIUM_ROWS = """
SELECT CASE WHEN agrees THEN 'matching_trans' ELSE 'amount_mismatch' END AS CATEGORY,
  tid AS LDG_TID, ctid AS COMMISSION_TID, CAST(ccomm AS DOUBLE) AS COMM_AMT, CAST(amt AS DOUBLE) AS LDG_AMOUNT,
  CAST(samt AS DOUBLE) AS STMT_AMOUNT, d AS DATE FROM paired
UNION ALL SELECT CASE WHEN agrees THEN 'MATCHED_NO_COMMISSION' ELSE 'amount_mismatch' END, tid, NULL, comm, amt, samt, d FROM both_sides b
WHERE NOT EXISTS (SELECT 1 FROM ledger_only c WHERE c.parent = b.tid)
UNION ALL SELECT 'not_in_statement', tid, NULL, comm, amt, NULL, d FROM ledger_only l
WHERE NOT EXISTS (SELECT 1 FROM paired p WHERE p.ctid = l.tid)
UNION ALL SELECT CASE WHEN stid IS NULL THEN 'UNCLASSIFIED' ELSE 'not_in_ledger' END,
  stid, NULL, NULL, NULL, samt, sd FROM stm
WHERE NOT EXISTS (SELECT 1 FROM led WHERE tid = stid)"""


@query("commission_reconcile", *PREMIUM_VIEWS, sql=f"WITH {PREMIUM_SQL}{PREMIUM_ROWS}")
def commission_reconcile(s: Source) -> DataFrame:
    return plain(
        reconcile_ledger("LIC", s["premium_ledger"], s["premium_statement"]).buckets
    )


@query(
    "commission_counts",
    *PREMIUM_VIEWS,
    sql=f"WITH {PREMIUM_SQL}, result AS ({PREMIUM_ROWS})\n"
    + metrics(
        {
            "ledger_count": count_of("led"),
            "ledger_credit_count": count_of("led", "comm IS NOT NULL AND comm <> 0"),
            "statement_count": count_of("stm", "stid IS NOT NULL"),
            "matched_trans_count": count_of("result", "CATEGORY = 'matching_trans'"),
            "amount_mismatch_shown_count": count_of(
                "result", "CATEGORY = 'amount_mismatch'"
            ),
            "failed_trans_count": f"""SELECT ({count_of("result", "CATEGORY IN ('not_in_ledger', 'not_in_statement')")})
  + ({count_of("both_sides", "NOT agrees")})""",
        }
    ),
)
def commission_counts(s: Source) -> DataFrame:
    return reconcile_ledger("LIC", s["premium_ledger"], s["premium_statement"]).counts


@query(
    "parent_child_commission",
    *PREMIUM_VIEWS,
    sql=f"""WITH {PREMIUM_SQL}
SELECT tid AS LDG_TID, ctid AS COMMISSION_TID, CAST(ccomm AS DOUBLE) AS COMM_AMT, agrees AS AGREES
FROM paired""",
)
def parent_child_commission(s: Source) -> DataFrame:
    led, stm = ledger_commission.prepare(s["premium_ledger"], s["premium_statement"])
    both = inner_match(led, stm, "LDG_TID", "STMT_TID", exact).withColumn(
        "AGREES", amounts_equal("LDG_AMOUNT", "STMT_AMOUNT")
    )
    ledger_only = missing_from(led, stm, "LDG_TID", "STMT_TID", exact)
    return plain(
        ledger_commission.children(both, ledger_only).select(
            "LDG_TID", "COMMISSION_TID", "COMM_AMT", "AGREES"
        )
    )


# ------------------------------------------------------------ daily totals

BOOKING_VIEWS = ("booking_statement", "booking_ledger")


def _exact(column: str) -> str:
    return f'TRY_CAST(trim("{column}") AS DECIMAL(38,18))'


def _bad(*columns: str) -> str:
    """Whether one of the columns has a text that is no amount."""
    return " OR ".join(
        f"""(coalesce(trim("{c}"), '') <> '' AND {_exact(c)} IS NULL)""" for c in columns
    )


BOOKING_SQL = f"""stm AS (SELECT *, CAST(try_strptime("Booked Date", '%d-%m-%Y %H:%M') AS DATE) AS day,
  lower(trim(Status)) AS st, ({_exact("Ticket Amount")} + {_exact("Service Tax")})
  - ({_exact("Comm.")} - {_exact("Comm TDS")}) AS final,
  {_bad("Ticket Amount", "Service Tax", "Comm.", "Comm TDS")} AS bad FROM booking_statement),
net AS (SELECT day, coalesce(sum(CASE WHEN st = 'success' THEN final END), 0)
    - coalesce(sum(CASE WHEN st = 'failed' THEN final END), 0) AS a,
    bool_or(bad AND st IN ('success', 'failed')) AS bad_net
  FROM stm WHERE day IS NOT NULL AND st IS NOT NULL GROUP BY day),
entries AS (SELECT *, CAST(try_strptime("Balance Date", '%d-%m-%Y') AS DATE) AS day,
  {_exact("Used Amount")} AS amount, {_bad("Used Amount")} AS bad FROM booking_ledger),
used AS (SELECT day, sum(amount) AS b, bool_or(bad) AS bad_used FROM entries
  WHERE day IS NOT NULL GROUP BY day),
days AS (SELECT coalesce(n.day, u.day) AS DAY, CAST(coalesce(a, 0) AS DOUBLE) AS AMOUNT_STATEMENT,
  CAST(coalesce(b, 0) AS DOUBLE) AS AMOUNT_LEDGER, coalesce(bad_net, FALSE) OR coalesce(bad_used, FALSE)
  AS open FROM net n FULL JOIN used u ON n.day = u.day),
verdicts AS (SELECT * EXCLUDE (open), CASE WHEN open THEN 'UNCLASSIFIED' WHEN abs(AMOUNT_STATEMENT - AMOUNT_LEDGER) <= 1e-5 + 1e-5 * abs(AMOUNT_LEDGER)
  THEN 'MATCHED' ELSE 'MISMATCHED' END AS MAPPING_STATUS FROM days)"""


@query(
    "daily_net_pivot",
    "booking_statement",
    "booking_ledger",
    sql=f"""WITH {BOOKING_SQL} SELECT day AS DAY, CAST(a AS DOUBLE) AS AMOUNT_STATEMENT FROM net""",
)
def daily_net_pivot(s: Source) -> DataFrame:
    _, stm = ledger_daily.prepare(s["booking_ledger"], s["booking_statement"])
    return plain(ledger_daily.daily_net(stm).drop("NET_UNREADABLE"))


@query("daily_compare", *BOOKING_VIEWS, sql=f"WITH {BOOKING_SQL} SELECT * FROM verdicts")
def daily_compare(s: Source) -> DataFrame:
    return reconcile_ledger("ABHIBUS", s["booking_ledger"], s["booking_statement"]).days


@query(
    "daily_verdict_rows",
    *BOOKING_VIEWS,
    sql=f"""WITH {BOOKING_SQL}
SELECT CASE MAPPING_STATUS WHEN 'MATCHED' THEN 'matching_trans' WHEN 'MISMATCHED' THEN 'amount_mismatch'
    ELSE 'UNCLASSIFIED' END AS CATEGORY, s."Tkt. Number" AS "TKT. NUMBER", AMOUNT_LEDGER, AMOUNT_STATEMENT,
  "Booked Date" AS "BOOKED DATE", "Ticket Amount" AS "TICKET AMOUNT", "Service Tax" AS "SERVICE TAX",
  "Comm." AS "COMM.", "Comm TDS" AS "COMM TDS", CAST(final AS DOUBLE) AS FINAL_AMOUNT, MAPPING_STATUS
FROM stm s LEFT JOIN verdicts v ON v.DAY = s.day
UNION ALL SELECT 'UNCLASSIFIED', NULL, amount, NULL, "Balance Date", NULL, NULL, NULL, NULL, NULL,
  'UNCLASSIFIED' FROM entries WHERE day IS NULL OR bad""",
)
def daily_verdict_rows(s: Source) -> DataFrame:
    return plain(
        reconcile_ledger(
            "ABHIBUS", s["booking_ledger"], s["booking_statement"]
        ).buckets
    )


@query(
    "daily_counts",
    *BOOKING_VIEWS,
    sql=f"WITH {BOOKING_SQL}, result AS (SELECT MAPPING_STATUS FROM stm s LEFT JOIN verdicts v ON v.DAY = s.day)\n"
    + metrics(
        {
            "ledger_count": count_of("booking_ledger"),
            "credit_count": count_of(
                "entries", "amount < 0"
            ),
            "statement_count": count_of("stm"),
            "matched_trans_count": count_of("result", "MAPPING_STATUS = 'MATCHED'"),
            "failed_trans_count": count_of("result", "MAPPING_STATUS = 'MISMATCHED'"),
        }
    ),
)
def daily_counts(s: Source) -> DataFrame:
    result: Result = reconcile_ledger(
        "ABHIBUS", s["booking_ledger"], s["booking_statement"]
    )
    return result.counts
