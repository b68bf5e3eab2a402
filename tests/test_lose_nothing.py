"""Every statement row of a ledger plan is in one bucket or in ``unplaced``."""

import collections

from tallybook.plans.ledger_amounts import reconcile_amounts
from tallybook.plans.ledger_settlement import reconcile_settlement


def placed(result, column):
    out = [(r[column], r["CATEGORY"]) for r in result.buckets.collect() if r[column]]
    return collections.Counter(out + [(r[column], r["CATEGORY"]) for r in result.unplaced.collect()])


def test_settlement_rows_balance(frame):
    ledger = frame(
        "SNO string, TXNTYPE string, TYPE string, AMOUNT string, DATE string",
        ("1", "x", "credit", "30", "d"),
        ("2", "x", "debit", "1", "d"),
        ("5", "x", "credit", "99", "d"),
    )
    statement = frame(
        "SETTLED_ID string, AMOUNT string, COMMISSION string, STATUS string, UTR string",
        ("1", "10", "0", "ok", "a"),
        ("1", "20", "0", "ok", "b"),
        ("5", "50", "0", "ok", "c"),
        ("5", "48", "0", "failed", "d"),
        ("8", "5", "0", "ok", "e"),
        ("8", "5", "0", "Failed", "f"),
        (None, "5", "0", "failed", "g"),
    )
    found = reconcile_settlement(ledger, statement)
    assert placed(found, "UTR") == collections.Counter(
        {
            ("a", "matching_trans"): 1,
            ("b", "matching_trans"): 1,
            ("c", "amount_mismatch"): 1,
            ("d", "amount_mismatch"): 1,
            ("e", "not_in_ledger"): 1,
            ("f", "UNCLASSIFIED"): 1,
            ("g", "UNCLASSIFIED"): 1,
        }
    )


def test_amount_rows_balance(frame):
    ledger = frame("UTR string, AMOUNT string, `CR/DR` string, DATE string", ("7", "5", "CR", "d"))
    statement = frame(
        "RRN string, AMOUNT string, BCID string",
        ("7", "5", "a"),
        ("8", "5", "b"),
        (" ", "5", "c"),
        (None, "5", "d"),
    )
    assert placed(reconcile_amounts(ledger, statement), "BCID") == collections.Counter(
        {
            ("a", "matching_trans"): 1,
            ("b", "not_in_ledger"): 1,
            ("c", "UNCLASSIFIED"): 1,
            ("d", "UNCLASSIFIED"): 1,
        }
    )
