"""What a query computes, shuffles and writes grows no faster than its input."""

import re

from conftest import rows_of
from tallybook.catalog import queries
from tallybook.plans.ledger_recon import reconcile_ledger


def analysed(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_settlement_rows_are_made_once(source):
    """Placed and unplaced statement rows come from one join; the staged ledger is not compared again."""
    found = reconcile_ledger("AEPS", source["settlement_ledger"], source["settled_statement"], stage=True)
    text = analysed(found.rows())
    assert len(re.findall(r"Join", text)) == 3
    apart = found.buckets.unionByName(found.unplaced, allowMissingColumns=True)
    assert rows_of(found.rows().select(apart.columns)) == rows_of(apart)


def test_commission_of_the_least_and_greatest_serial_number(frame):
    ends = [str(-(1 << 63)), str((1 << 63) - 2)]
    ledger = frame(
        "SNO string, TXNTYPE string, TYPE string, AMOUNT string, DATE string",
        *[(n, "x", "credit", "5", "d") for n in (*ends, "7", "8")],
    )
    statement = frame(
        "SETTLED_ID string, AMOUNT string, COMMISSION string, STATUS string", ("7", "5", "0", "ok")
    )
    found = reconcile_ledger("AEPS", ledger, statement)
    got = {r["SETTLED_ID"]: (r["CATEGORY"], r["COMMISSION_SNO"]) for r in found.rows().collect()}
    missing = {int(n): ("not_in_statement", None) for n in ends}
    assert got == {7: ("matching_trans", 8), **missing}


def test_exception_report_is_made_once(source):
    found = reconcile_ledger("MATM", source["atm_ledger"], source["atm_statement"])
    kept = found.exceptions_kept("CATEGORY")
    assert "Join" in analysed(found.combined())
    assert "Join" not in analysed(kept.combined())
    assert kept.has_exceptions()
    assert rows_of(kept.combined()) == rows_of(found.combined().select("CATEGORY"))


def test_payment_buckets_read_kept_sides(spark, sf_dir):
    """The vendor rows are grouped and the payments given their credits once, not once per bucket."""
    text = analysed(queries()["upi_buckets"](spark, sf_dir))
    assert not re.search(r"l_orderkey|o_orderkey|c_custkey", text)
