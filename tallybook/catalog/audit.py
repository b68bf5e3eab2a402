"""What becomes of every input row: rejects, lines that do not fit, row balances."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.ledgers import (
    ATM_ROWS,
    ATM_SQL,
    ATM_VIEWS,
    BANK_SQL,
    BANK_VIEWS,
    CARD_SQL,
    CARD_VIEWS,
    PREMIUM_SQL,
    PREMIUM_VIEWS,
    REFUND_PARTS,
    REFUND_SQL,
    REFUND_VIEWS,
    SETTLED_SQL,
    SETTLED_VIEWS,
    UNKNOWN_SETTLEMENT,
)
from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.config.ledger_files import ledger_files
from tallybook.operators.columns import union_aligned
from tallybook.operators.rejects import reject_counts, rejected
from tallybook.plans.balance import reconcile_balanced
from tallybook.plans.ledger_recon import reconcile_ledger
from tallybook.sources.files import read_csv, text_schema
from tallybook.sources.staging import SETTING, staging_folder


def shared_folder(s: Source) -> str:
    """The cluster's shared folder; in local mode a temporary one if none is set."""
    if not s.spark.conf.get(SETTING, None) and re.match(r"local\b", s.spark.sparkContext.master):
        s.spark.conf.set(SETTING, tempfile.mkdtemp(prefix="tallybook-"))
    return staging_folder(s.spark)


# ---------------------------------------------------------------- rejects

# service, ledger view, statement view
REJECT_VIEWS = (
    ("RECHARGE", "soiled_refund_ledger", "soiled_refund_statement"),
    ("AEPS", "soiled_settlement_ledger", "soiled_settled_statement"),
    ("MATM", "atm_ledger", "atm_statement"),
    ("BBPS", "soiled_bank_ledger", "soiled_bank_statement"),
    ("LIC", "soiled_premium_ledger", "premium_statement"),
    ("PANUTI", "soiled_card_ledger", "soiled_card_statement"),
    ("ABHIBUS", "booking_ledger", "booking_statement"),
)
_ALL_REJECT_VIEWS = tuple(v for _, *views in REJECT_VIEWS for v in views)


def _present(c: str) -> str:
    return f"coalesce(trim({c}), '') <> ''"


def _no_amount(c: str) -> str:
    return f"{_present(c)} AND TRY_CAST(trim({c}) AS DECIMAL(38,18)) IS NULL"


def _no_serial(c: str) -> str:
    return f"{_present(c)} AND NOT regexp_matches(trim({c}), '^[+-]?\\d{{1,18}}(\\.0)?$')"


def _no_date(c: str, *layouts: str) -> str:
    read = ", ".join(f"try_strptime({c}, '{layout}')" for layout in layouts)
    return f"{_present(c)} AND coalesce({read}) IS NULL"


_ISO = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S")
# service, view, side, and for each reason the condition
REJECT_TESTS = (
    (
        "RECHARGE",
        "soiled_refund_ledger",
        "ledger",
        {
            "AMOUNT: amount": _no_amount("AMOUNT"),
            "COMM/SHARE: amount": _no_amount('"COMM/SHARE"'),
            "TDS: amount": _no_amount("TDS"),
            "DATE: date": _no_date("DATE", *_ISO),
        },
    ),
    (
        "RECHARGE",
        "soiled_refund_statement",
        "statement",
        {
            "AMOUNT: amount": _no_amount("AMOUNT"),
            "NET COMMISSION: amount": _no_amount('"NET COMMISSION"'),
            "TDS: amount": _no_amount("TDS"),
            "DATE: date": _no_date("DATE", *_ISO),
        },
    ),
    (
        "AEPS",
        "soiled_settlement_ledger",
        "ledger",
        {"SNO: serial number": _no_serial("SNO"), "AMOUNT: amount": _no_amount("AMOUNT")},
    ),
    (
        "AEPS",
        "soiled_settled_statement",
        "statement",
        {"SETTLED_ID: serial number": _no_serial("SETTLED_ID"), "AMOUNT: amount": _no_amount("AMOUNT")},
    ),
    ("MATM", "atm_ledger", "ledger", {"AMOUNT: amount": _no_amount("replace(replace(Amount, '₹', ''), ' ', '')")}),
    ("MATM", "atm_statement", "statement", {"AMOUNT: amount": _no_amount("Amount")}),
    (
        "BBPS",
        "soiled_bank_ledger",
        "ledger",
        {"DEBIT: amount": _no_amount("Debit"), "CREDIT: amount": _no_amount("Credit")},
    ),
    (
        "BBPS",
        "soiled_bank_statement",
        "statement",
        {"TRANSACTION AMOUNT(RS.): amount": _no_amount('"Transaction Amount(RS.)"')},
    ),
    ("LIC", "soiled_premium_ledger", "ledger", {"DR: amount": _no_amount("DR"), "CR: amount": _no_amount("CR")}),
    ("LIC", "premium_statement", "statement", {"AMOUNT: amount": _no_amount("Amount")}),
    ("PANUTI", "soiled_card_ledger", "ledger", {"UTIITSL AMOUNT: amount": _no_amount('"UTIITSL Amount"')}),
    ("PANUTI", "soiled_card_statement", "statement", {"RES AMOUNT: amount": _no_amount('"Res Amount"')}),
    (
        "ABHIBUS",
        "booking_ledger",
        "ledger",
        {
            "BALANCE DATE: date": _no_date('"Balance Date"', "%d-%m-%Y"),
            "USED AMOUNT: amount": _no_amount('"Used Amount"'),
        },
    ),
    (
        "ABHIBUS",
        "booking_statement",
        "statement",
        {
            "BOOKED DATE: date": _no_date('"Booked Date"', "%d-%m-%Y %H:%M"),
            "TICKET AMOUNT: amount": _no_amount('"Ticket Amount"'),
            "SERVICE TAX: amount": _no_amount('"Service Tax"'),
            "COMM.: amount": _no_amount('"Comm."'),
            "COMM TDS: amount": _no_amount('"Comm TDS"'),
        },
    ),
)


def _reason(tests: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in tests.items())
    return f"concat_ws(', ', {cases})"


REJECT_SQL = "\nUNION ALL ".join(
    f"SELECT '{service}' AS SERVICE, '{side}' AS SIDE, {_reason(tests)} AS REASON FROM {view}"
    for service, view, side, tests in REJECT_TESTS
)


@query(
    "ledger_rejects",
    *_ALL_REJECT_VIEWS,
    sql=f"""WITH r AS ({REJECT_SQL})
SELECT SERVICE, SIDE, REASON, count(*) AS n FROM r WHERE REASON <> '' GROUP BY SERVICE, SIDE, REASON""",
)
def ledger_rejects(s: Source) -> DataFrame:
    """Rows with unreadable values of all ledger reconciliations, by reason."""
    return union_aligned(
        *[
            reject_counts(reconcile_ledger(service, s[led], s[stm]).rejects).select(
                F.lit(service).alias("SERVICE"), "SIDE", "REASON", "n"
            )
            for service, led, stm in REJECT_VIEWS
        ]
    )


@query(
    "settlement_reject_rows",
    "soiled_settlement_ledger",
    "soiled_settled_statement",
    sql=f"""WITH r AS (SELECT 'ledger' AS SIDE, {_reason(REJECT_TESTS[2][3])} AS REASON, SNO AS ID,
  AMOUNT FROM soiled_settlement_ledger
UNION ALL SELECT 'statement', {_reason(REJECT_TESTS[3][3])}, SERIALNUMBER, AMOUNT FROM soiled_settled_statement)
SELECT * FROM r WHERE REASON <> ''""",
)
def settlement_reject_rows(s: Source) -> DataFrame:
    """Each rejected row with its reasons; its own values come from the record."""
    found = reconcile_ledger("AEPS", s["soiled_settlement_ledger"], s["soiled_settled_statement"])
    record = F.from_json("RECORD", "SNO string, SERIALNUMBER string, AMOUNT string")
    return found.rejects.select("SIDE", "REASON", record.alias("r")).select(
        "SIDE", "REASON", F.coalesce("r.SNO", "r.SERIALNUMBER").alias("ID"), "r.AMOUNT"
    )


# -------------------------------------------- files with lines that do not fit

# Endings of the key on which a line loses its last field, and gets one more.
CUT, LONGER = "9", "8"
FITS = f"NOT (trim(TXNID) LIKE '%{CUT}' OR trim(TXNID) LIKE '%{LONGER}')"
LINE_SQL = f"""stm AS (SELECT TXNID, STATUS FROM refund_statement WHERE {FITS}),
led AS (SELECT TXNID, TYPE FROM refund_ledger WHERE {FITS})"""


def csv_file(s: Source, view: str) -> DataFrame:
    """A view written as a CSV file in which some lines have a field too few or too many, and read again."""
    df = s[view]
    key, line = F.trim("TXNID"), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(key.endswith(CUT), F.regexp_replace(line, ",[^,]*$", "")).when(
        key.endswith(LONGER), F.concat(line, F.lit(",more"))
    ).otherwise(line)
    path = f"{shared_folder(s)}/tallybook/{uuid.uuid4().hex}"
    df.select(line.alias("value")).write.text(path)
    return read_csv(s.spark, path, text_schema(df.columns), keep_malformed=True, header=False)


@query(
    "csv_line_rejects",
    *REFUND_VIEWS,
    sql=f"""SELECT 'ledger' AS SIDE, TXNID, 'layout' AS REASON FROM refund_ledger WHERE NOT ({FITS})
UNION ALL SELECT 'statement', TXNID, 'layout' FROM refund_statement WHERE NOT ({FITS})""",
)
def csv_line_rejects(s: Source) -> DataFrame:
    """Lines with too few or too many fields, as they are in the file."""
    led, stm = csv_file(s, "refund_ledger"), csv_file(s, "refund_statement")
    files = ledger_files("RECHARGE")
    found = rejected(led, "ledger", files.ledger).unionByName(rejected(stm, "statement", files.statement))
    return found.select("SIDE", F.substring_index("RECORD", ",", 1).alias("TXNID"), "REASON")


@query(
    "csv_refund_reconcile",
    *REFUND_VIEWS,
    sql=f"""WITH {LINE_SQL}, matched AS (SELECT s.*, l.TYPE FROM stm s JOIN led l ON trim(s.TXNID) = trim(l.TXNID))
SELECT 'matching_trans' AS CATEGORY, TXNID, STATUS FROM matched WHERE STATUS IS NULL OR STATUS <> 'failed'
UNION ALL SELECT 'not_in_ledger', TXNID, STATUS FROM stm s
WHERE NOT EXISTS (SELECT 1 FROM led l WHERE trim(l.TXNID) = trim(s.TXNID))""",
)
def csv_refund_reconcile(s: Source) -> DataFrame:
    """A reconciliation of two scanned files; lines that do not fit take no part."""
    found = reconcile_ledger("RECHARGE", csv_file(s, "refund_ledger"), csv_file(s, "refund_statement"))
    rows = found.buckets.where(F.col("CATEGORY").isin("matching_trans", "not_in_ledger"))
    return rows.select("CATEGORY", "TXNID", "STATUS")


# -------------------------------------------------------- exception reports


def exceptions_of(s: Source, service: str, ledger: str, statement: str) -> DataFrame:
    """Sizes of the exception report's buckets, and whether there is any exception."""
    shared_folder(s)
    found = reconcile_ledger(service, s[ledger], s[statement], stage=True).exceptions_kept("CATEGORY")
    flag = [("HAS_EXCEPTIONS", int(found.has_exceptions()))]
    sizes = found.combined().groupBy("CATEGORY").agg(F.count("*").alias("n"))
    return sizes.unionByName(s.spark.createDataFrame(flag, "CATEGORY string, n long"))


def exceptions_sql(steps: str, rows: str) -> str:
    return f"""WITH {steps}, found AS ({rows})
SELECT CATEGORY, count(*) AS n FROM found GROUP BY CATEGORY
UNION ALL SELECT 'HAS_EXCEPTIONS', CASE WHEN EXISTS (SELECT 1 FROM found) THEN 1 ELSE 0 END"""


@query(
    "amount_exceptions",
    *ATM_VIEWS,
    sql=exceptions_sql(
        ATM_SQL,
        f"""SELECT CATEGORY FROM ({ATM_ROWS}) r WHERE CATEGORY <> 'matching_trans'
UNION ALL SELECT 'UNCLASSIFIED' FROM atm_statement WHERE RRN IS NULL OR trim(RRN) = ''""",
    ),
)
def amount_exceptions(s: Source) -> DataFrame:
    return exceptions_of(s, "MATM", "atm_ledger", "atm_statement")


@query(
    "settlement_exceptions",
    *SETTLED_VIEWS,
    sql=exceptions_sql(
        SETTLED_SQL,
        f"""SELECT 'amount_mismatch' AS CATEGORY FROM compared WHERE total <> AMOUNT
UNION ALL SELECT 'amount_mismatch' FROM stm WHERE SETTLED_ID IN (SELECT SETTLED_ID FROM compared WHERE total <> AMOUNT)
UNION ALL SELECT 'MATCHED_NO_COMMISSION' FROM detail WHERE SNO + 1 NOT IN (SELECT SNO FROM commission)
UNION ALL SELECT 'not_in_statement' FROM idle WHERE SNO NOT IN (SELECT SNO FROM commission)
UNION ALL SELECT CASE WHEN lower(STATUS) = 'failed' THEN 'UNCLASSIFIED' ELSE 'not_in_ledger' END FROM stm
WHERE SETTLED_ID IS NULL OR SETTLED_ID NOT IN (SELECT SNO FROM led)""",
    ),
)
def settlement_exceptions(s: Source) -> DataFrame:
    """A settlement that is off shows all its statement rows."""
    return exceptions_of(s, "AEPS", "settlement_ledger", "settled_statement")


# ------------------------------------------------------------ row balances


def _numbered(sql: str, **views: str) -> str:
    """``sql`` with a row number, under the given name, in the step that reads each view."""
    for view, name in views.items():
        sql, n = re.subn(rf"\s+FROM {view}\b", f", row_number() OVER () AS {name} FROM {view}", sql)
        assert n == 1, (view, n)
    return sql


def balance_sql(steps: str, ledger: str, statement: str, parts: list[tuple[str, str, str, str]]) -> str:
    """``(SIDE, CATEGORY, n)`` from ``(side, category expression, row number, rows)`` of each bucket.

    Every bucket is stated for itself; the number of rows in and of rows placed are counted from the
    input and from all buckets together.
    """
    placed = "\nUNION ALL ".join(
        f"SELECT '{side}' AS SIDE, {category} AS CATEGORY, {row} AS r FROM {rows}" for side, category, row, rows in parts
    )
    return f"""WITH {steps}, placed AS ({placed})
SELECT SIDE, CATEGORY, count(DISTINCT r) AS n FROM placed GROUP BY SIDE, CATEGORY
UNION ALL SELECT SIDE, 'ROWS_PLACED', count(DISTINCT r) FROM placed GROUP BY SIDE
UNION ALL SELECT 'ledger', 'ROWS_IN', count(*) FROM {ledger}
UNION ALL SELECT 'statement', 'ROWS_IN', count(*) FROM {statement}"""


def balance_of(s: Source, service: str, ledger: str, statement: str) -> DataFrame:
    shared_folder(s)
    return reconcile_balanced(service, s[ledger], s[statement]).table


NOT_FAILED = "STATUS IS NULL OR STATUS <> 'failed'"
REFUND_BALANCE = balance_sql(
    _numbered(f"{REFUND_SQL},\n{REFUND_PARTS}", refund_statement="sn", refund_ledger="ln").replace(
        "l.TYPE FROM stm", "l.TYPE, l.ln FROM stm"
    ),
    "refund_ledger",
    "refund_statement",
    [
        (side, category, row, rows)
        for side, row in (("ledger", "ln"), ("statement", "sn"))
        for category, rows in (
            (f"CASE WHEN {NOT_FAILED} THEN 'matching_trans' ELSE 'FAILED_PAIR' END", "matched"),
            ("'matching_refunds'", "(SELECT r.ln, f.sn FROM failed f JOIN refund_rows r ON trim(r.TXNID) = f.REFUND_TXNID) x"),
        )
    ]
    + [
        ("ledger", "'not_in_statement'", "ln", "refund_rows r WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.REFUND_TXNID = trim(r.TXNID))"),
        ("statement", "'not_in_ledger'", "sn", "stm s WHERE NOT EXISTS (SELECT 1 FROM led l WHERE trim(l.TXNID) = trim(s.TXNID))"),
        ("statement", "'failed_not_refunded'", "sn", "failed f WHERE NOT EXISTS (SELECT 1 FROM refund_rows r WHERE trim(r.TXNID) = f.REFUND_TXNID)"),
    ],
)


@query("refund_row_balance", *REFUND_VIEWS, sql=REFUND_BALANCE)
def refund_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "RECHARGE", "refund_ledger", "refund_statement")


_OPEN = "STATUS IS NULL OR lower(STATUS) <> 'failed'"
SETTLED_BALANCE = balance_sql(
    _numbered(SETTLED_SQL, settled_statement="sn", settlement_ledger="ln").replace(
        "a.AMOUNT AS AMOUNT_LEDGER, s.*", "a.AMOUNT AS AMOUNT_LEDGER, a.ln, s.*"
    )
    # the ledger rows that the first step leaves out
    + """, other AS (SELECT row_number() OVER () AS on_ FROM settlement_ledger
  WHERE regexp_matches(lower(TXNTYPE), 'settlement|merchant two factor authentication charges|ministatement')),
commission_of AS (SELECT d.*, c.ln AS cn FROM detail d LEFT JOIN commission c ON c.SNO = d.SNO + 1)""",
    "settlement_ledger",
    "settled_statement",
    [
        ("ledger", "CASE WHEN cn IS NULL THEN 'MATCHED_NO_COMMISSION' ELSE 'matching_trans' END", "ln", "commission_of"),
        ("ledger", "'matching_trans'", "cn", "commission_of WHERE cn IS NOT NULL"),
        ("ledger", "'amount_mismatch'", "ln", "compared WHERE total <> AMOUNT"),
        ("ledger", "'not_in_statement'", "ln", "idle WHERE SNO NOT IN (SELECT SNO FROM commission)"),
        ("ledger", "'NON_TRANSACTION'", "-on_", "other"),
        ("statement", "CASE WHEN cn IS NULL THEN 'MATCHED_NO_COMMISSION' ELSE 'matching_trans' END", "sn", "commission_of"),
        ("statement", "'amount_mismatch'", "sn", "stm WHERE SETTLED_ID IN (SELECT SETTLED_ID FROM compared WHERE total <> AMOUNT)"),
        ("statement", "'not_in_ledger'", "sn", f"stm WHERE {UNKNOWN_SETTLEMENT}"),
        (
            "statement",
            "'UNCLASSIFIED'",
            "sn",
            "stm WHERE (SETTLED_ID IS NULL OR SETTLED_ID NOT IN (SELECT SNO FROM led)) AND lower(STATUS) = 'failed'",
        ),
    ],
)


@query("settlement_row_balance", *SETTLED_VIEWS, sql=SETTLED_BALANCE)
def settlement_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "AEPS", "settlement_ledger", "settled_statement")


_AGREES = "CASE WHEN AMOUNT_LEDGER = AMOUNT_STATEMENT THEN 'matching_trans' ELSE 'amount_mismatch' END"
ATM_BALANCE = balance_sql(
    _numbered(ATM_SQL, atm_ledger="ln", atm_statement="sn")
    + """, blank AS (SELECT -row_number() OVER () AS bn FROM atm_statement WHERE RRN IS NULL OR trim(RRN) = '')""",
    "atm_ledger",
    "atm_statement",
    [
        ("ledger", _AGREES, "ln", "both_sides"),
        ("statement", _AGREES, "sn", "both_sides"),
        ("ledger", "'not_in_statement'", "ln", "led l WHERE NOT EXISTS (SELECT 1 FROM stm WHERE RRN = l.UTR)"),
        ("statement", "'not_in_ledger'", "sn", "stm s WHERE NOT EXISTS (SELECT 1 FROM led WHERE UTR = s.RRN)"),
        ("statement", "'UNCLASSIFIED'", "bn", "blank"),
    ],
)


@query("amount_row_balance", *ATM_VIEWS, sql=ATM_BALANCE)
def amount_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "MATM", "atm_ledger", "atm_statement")


CARD_BALANCE = balance_sql(
    _numbered(CARD_SQL, card_ledger="ln", card_statement="sn")
    + """, refunded AS (SELECT -row_number() OVER () AS rn FROM card_statement
  WHERE "Payment Status" = 'Payment Refunded due to Incomplete Application')""",
    "card_ledger",
    "card_statement",
    [
        ("ledger", "'matching_trans'", "ln", "led JOIN stm ON LDG_REFERENCE_NO = STMT_REFERENCE_NO"),
        ("statement", "'matching_trans'", "sn", "led JOIN stm ON LDG_REFERENCE_NO = STMT_REFERENCE_NO"),
        ("ledger", "'not_in_statement'", "ln", "led WHERE NOT EXISTS (SELECT 1 FROM stm WHERE LDG_REFERENCE_NO = STMT_REFERENCE_NO)"),
        ("statement", "'not_in_ledger'", "sn", "stm WHERE NOT EXISTS (SELECT 1 FROM led WHERE LDG_REFERENCE_NO = STMT_REFERENCE_NO)"),
        ("statement", "'REFUNDED'", "rn", "refunded"),
    ],
)


@query("reference_row_balance", *CARD_VIEWS, sql=CARD_BALANCE)
def reference_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "PANUTI", "card_ledger", "card_statement")


_ALONE = "both_sides b WHERE NOT EXISTS (SELECT 1 FROM ledger_only c WHERE c.parent = b.tid)"
_PAIR, _SINGLE = (
    f"CASE WHEN agrees THEN '{name}' ELSE 'amount_mismatch' END" for name in ("matching_trans", "MATCHED_NO_COMMISSION")
)
PREMIUM_BALANCE = balance_sql(
    _numbered(PREMIUM_SQL, premium_ledger="ln", premium_statement="sn").replace(
        "c.comm AS ccomm", "c.comm AS ccomm, c.ln AS cn"
    ),
    "premium_ledger",
    "premium_statement",
    [
        ("ledger", _PAIR, "ln", "paired"),
        ("ledger", _PAIR, "cn", "paired"),
        ("ledger", _SINGLE, "ln", _ALONE),
        ("ledger", "'not_in_statement'", "ln", "ledger_only l WHERE NOT EXISTS (SELECT 1 FROM paired p WHERE p.cn = l.ln)"),
        ("statement", _PAIR, "sn", "paired"),
        ("statement", _SINGLE, "sn", _ALONE),
        (
            "statement",
            "CASE WHEN stid IS NULL THEN 'UNCLASSIFIED' ELSE 'not_in_ledger' END",
            "sn",
            "stm WHERE NOT EXISTS (SELECT 1 FROM led WHERE tid = stid)",
        ),
    ],
)


@query("commission_row_balance", *PREMIUM_VIEWS, sql=PREMIUM_BALANCE)
def commission_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "LIC", "premium_ledger", "premium_statement")


_MATCHED = "CASE WHEN says_failed AND REFUNDED_AMOUNT IS NULL THEN 'failed_not_refunded' ELSE 'matching_trans' END"
_IS_REFUND = r"coalesce(Credit IS NOT NULL AND regexp_matches(Description, '^(BBPS-)?[A-Z]{2,3}\d{1,2}-REF-'), FALSE)"
BANK_BALANCE = balance_sql(
    _numbered(BANK_SQL, bank_ledger="ln", bank_statement="sn")
    .replace("AS ACTUAL_TRANS_DATE\n  FROM led", "AS ACTUAL_TRANS_DATE, ln AS rn\n  FROM led")
    .replace("SELECT ref, AMOUNT_LEDGER, led_date, stm.*", "SELECT ref, AMOUNT_LEDGER, led_date, ln, stm.*")
    .replace("SELECT e.*, r.REFUNDED_AMOUNT,", "SELECT e.*, r.REFUNDED_AMOUNT, r.rn,")
    .replace("SELECT e.*, c.REFUNDED_AMOUNT FROM", "SELECT e.*, c.REFUNDED_AMOUNT, c.rn FROM")
    .replace("SELECT rid, REFUNDED_AMOUNT FROM checked", "SELECT rid, REFUNDED_AMOUNT, rn FROM checked"),
    "bank_ledger",
    "bank_statement",
    [
        ("ledger", _MATCHED, "ln", "with_refund"),
        ("ledger", _MATCHED, "rn", "with_refund WHERE rn IS NOT NULL"),
        ("statement", _MATCHED, "sn", "with_refund"),
        ("ledger", "'amount_mismatch'", "ln", "both_sides WHERE AMOUNT_LEDGER <> AMOUNT_STATEMENT"),
        ("statement", "'amount_mismatch'", "sn", "both_sides WHERE AMOUNT_LEDGER <> AMOUNT_STATEMENT"),
        ("ledger", "'not_in_statement'", "ln", "led WHERE starts_with(ref, 'KM') AND ref NOT IN (SELECT sref FROM stm)"),
        ("statement", "'not_in_ledger'", "sn", "stm WHERE NOT EXISTS (SELECT 1 FROM led WHERE ref = sref)"),
        ("ledger", "'refund_amount_mismatch'", "ln", "checked WHERE NOT agrees"),
        ("ledger", "'refund_amount_mismatch'", "rn", "checked WHERE NOT agrees"),
        ("statement", "'refund_amount_mismatch'", "sn", "checked WHERE NOT agrees"),
        (
            "ledger",
            "'Credit_Trans_in_Ledger_not_in_Stmnt'",
            "rn",
            "refunds WHERE NOT EXISTS (SELECT 1 FROM stm WHERE sref = rref)",
        ),
        (
            "ledger",
            "'REFUND_WITHOUT_FAILURE'",
            "rn",
            "refunds WHERE rref IN (SELECT sref FROM stm) AND rref NOT IN (SELECT ref FROM equal WHERE looks_failed)",
        ),
        (
            "ledger",
            "'UNCLASSIFIED'",
            "ln",
            f"led WHERE NOT {_IS_REFUND} AND NOT coalesce(starts_with(ref, 'KM'), FALSE)"
            " AND NOT EXISTS (SELECT 1 FROM stm WHERE sref = ref)",
        ),
    ],
)


@query("bill_row_balance", *BANK_VIEWS, sql=BANK_BALANCE)
def bill_row_balance(s: Source) -> DataFrame:
    return balance_of(s, "BBPS", "bank_ledger", "bank_statement")
