"""Rejects, row balances, counts without pairs, bucket files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallybook.errors import ContractError, UnbalancedError
from tallybook.operators.rejects import accepted, amount, currency, date, reject_counts, rejected, serial
from tallybook.operators.summary import stacked_sums
from tallybook.plans import balance
from tallybook.plans.ledger_recon import LEDGER_PLANS, reconcile_ledger
from tallybook.sources import sinks
from tallybook.sources.files import MALFORMED, read_csv, text_schema

PAIRS = {
    "RECHARGE": ("refund_ledger", "refund_statement"),
    "DMT": ("refund_ledger", "column_refund_statement"),
    "AEPS": ("settlement_ledger", "settled_statement"),
    "MATM": ("atm_ledger", "atm_statement"),
    "BBPS": ("bank_ledger", "bank_statement"),
    "LIC": ("premium_ledger", "premium_statement"),
    "PANUTI": ("card_ledger", "card_statement"),
}


def test_reasons(frame):
    df = frame(
        "`Amount ` string, fee string, no string, day string",
        ("1.5", "₹ 2", "3.0", "2024-01-31"),
        ("1,5", "Rs 2", "3.5", "31-01-2024"),
        ("1e3", " ", None, ""),
        (None, "₹", "12345678901234567890", "2024-02-30"),
        (" x ", "2", "-7", "2024-01-31"),
    )
    checks = [amount("AMOUNT"), currency("FEE"), serial("NO"), date("DAY", ("yyyy-MM-dd",)), amount("NOT THERE")]
    found = rejected(df, "ledger", checks).select("SIDE", "REASON", F.get_json_object("RECORD", "$.no"))
    assert rows_of(found) == sorted(
        [
            ("ledger", "AMOUNT: amount, FEE: amount, NO: serial number, DAY: date", "3.5"),
            ("ledger", "NO: serial number, DAY: date", "12345678901234567890"),
            ("ledger", "AMOUNT: amount", "-7"),
        ],
        key=repr,
    )
    assert rejected(df.limit(0), "ledger", checks).count() == 0
    assert rejected(df, "ledger", []).count() == 0
    assert rows_of(reject_counts(rejected(df, "s", checks[:1]))) == [("s", "AMOUNT: amount", 2)]


def test_lines_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a,b,c\n1,x,2.5\n2,y\n3,"z, z",4.5,more\n4,w,five\n,,\n')
    text = read_csv(spark, str(path), text_schema(["a", "b", "c"]), keep_malformed=True)
    assert rows_of(accepted(text)) == [("1", "x", "2.5"), ("4", "w", "five"), (None, None, None)]
    assert rows_of(rejected(text, "ledger", [amount("C")])) == sorted(
        [
            ("ledger", "layout", "2,y"),
            ("ledger", "layout", '3,"z, z",4.5,more'),
            ("ledger", "C: amount", '{"a":"4","b":"w","c":"five"}'),
        ],
        key=repr,
    )
    # a typed scan: a value of another type makes the line a reject
    typed = read_csv(spark, str(path), {"a": "int", "b": "string", "c": "double"}, keep_malformed=True)
    assert rows_of(accepted(typed)) == [(1, "x", 2.5), (None, None, None)]
    lines = [r["RECORD"] for r in rejected(typed, "ledger", []).collect()]
    assert sorted(lines) == ["2,y", '3,"z, z",4.5,more', "4,w,five"]
    # one that reads only some columns still sees them
    assert len(rejected(typed.select("a", MALFORMED), "ledger", []).collect()) == 3
    with pytest.raises(ContractError):
        read_csv(spark, str(path), keep_malformed=True)


def test_rejected_lines_take_no_part(spark, frame, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("1,5,CR,d\n2,five,CR,d\n3,7\n")
    ledger = read_csv(
        spark, str(path), text_schema(["UTR", "AMOUNT", "CR/DR", "DATE"]), keep_malformed=True, header=False
    )
    statement = frame("RRN string, AMOUNT string", ("1", "5"), ("3", "7"))
    found = reconcile_ledger("MATM", ledger, statement)
    assert rows_of(found.buckets.select("CATEGORY", "RRN")) == [
        ("matching_trans", "1"),
        ("not_in_ledger", "3"),
        ("not_in_statement", "2"),
    ]
    assert rows_of(found.rejects.select("SIDE", "REASON")) == [("ledger", "AMOUNT: amount"), ("ledger", "layout")]


@pytest.mark.parametrize("service", PAIRS)
def test_counts_equal_counted_buckets(source, service):
    """The counts come from grouped keys, the buckets from joins."""
    ledger, statement = (source[v] for v in PAIRS[service])
    found = reconcile_ledger(service, ledger, statement)
    counts = dict(rows_of(found.counts))
    sizes = dict(rows_of(found.sizes()))
    unplaced = {} if found.unplaced is None else dict(rows_of(found.unplaced.groupBy("CATEGORY").count()))
    assert counts["ledger_count"] == ledger.count()
    alone = sizes["not_in_ledger"] + sizes["not_in_statement"]
    if service in ("RECHARGE", "DMT"):
        assert counts["matching_trans_count"] == sizes["matching_trans"]
        assert counts["matched_trans_count"] == sizes["matching_trans"] + unplaced["FAILED_PAIR"]
    elif service in ("AEPS", "MATM"):
        assert counts["matched_trans_count"] == sizes["matching_trans"]
        assert counts["failed_trans_count"] == alone
    elif service == "PANUTI":
        assert counts["matched_trans_count"] == sizes["matching_trans"]
        assert counts["failed_trans_count"] == alone + unplaced["REFUNDED"]
    elif service == "BBPS":
        wrong = sizes["amount_mismatch"] + sizes["refund_amount_mismatch"]
        assert counts["failed_trans_count"] == alone + wrong
    else:
        assert counts["matched_trans_count"] == sizes["matching_trans"]
        assert counts["amount_mismatch_shown_count"] == sizes["amount_mismatch"]


@pytest.mark.parametrize("service", PAIRS)
def test_counts_join_only_grouped_rows(source, service):
    ledger, statement = (source[v] for v in PAIRS[service])
    plan = reconcile_ledger(service, ledger, statement).counts._jdf.queryExecution().optimizedPlan()

    def joins(node):
        found = [node] if node.getClass().getSimpleName() == "Join" else []
        children = node.children()
        return found + [j for i in range(children.length()) for j in joins(children.apply(i))]

    def grouped(node):
        if node.getClass().getSimpleName() in ("Aggregate", "Join"):
            return True
        children = node.children()
        return children.length() == 1 and grouped(children.apply(0))

    own = [j for j in joins(plan)]
    if service in ("RECHARGE", "DMT", "MATM", "BBPS", "PANUTI"):
        assert not own
    assert all(grouped(j.children().apply(side)) for j in own for side in (0, 1))


def test_counts_with_repeated_and_missing_keys(frame):
    """Against counts over the pairs themselves, on keys that repeat on both sides."""
    ledger = frame(
        "UTR string, AMOUNT string, `CR/DR` string, DATE string",
        *[(k, a, "CR", "d") for k in ("1", "2", "", None) for a in ("5", "5", "6", None)],
        ("9", "1", "Dr", "d"),
    )
    statement = frame(
        "RRN string, AMOUNT string",
        *[(k, a) for k in ("1", "2", "", None, "7") for a in ("5", "6.0", "6", None)],
    )
    found = reconcile_ledger("MATM", ledger, statement)
    sizes, counts = dict(rows_of(found.sizes())), dict(rows_of(found.counts))
    assert counts["matched_trans_count"] == sizes["matching_trans"] == 2 * (2 + 2 + 1)
    assert counts["failed_trans_count"] == sizes["not_in_ledger"] + sizes["not_in_statement"] == 4 + 9
    assert (counts["ledger_count"], counts["statement_count"], counts["ledger_credit_count"]) == (17, 20, 16)
    empty = reconcile_ledger("MATM", ledger.limit(0), statement.limit(0)).counts
    assert {r["value"] for r in empty.collect()} == {0}


def test_stacked_sums(frame):
    a, b = frame("k string, x int", ("a", 1), ("a", 2), (None, 3)), frame("q string", ("a",), ("b",))
    found = stacked_sums(["k"], (a, [F.col("k")], {"x": F.col("x")}), (b, [F.col("q")], {"n": F.lit(1)}))
    assert rows_of(found) == [("a", 3, 1), ("b", 0, 1), (None, 3, 0)]


@pytest.mark.parametrize("service", PAIRS)
def test_every_row_is_accounted_for(source, service):
    found = balance.reconcile_balanced(service, *(source[v] for v in PAIRS[service]))
    assert found.missing() == {"ledger": 0, "statement": 0}
    assert found.rows_in == {side: source[v].count() for side, v in zip(("ledger", "statement"), PAIRS[service])}
    assert min(r["n"] for r in found.table.collect()) > 0


def test_balance_counts_rows_of_repeated_keys_once(frame):
    ledger = frame("UTR string, AMOUNT string, `CR/DR` string, DATE string", *[("1", "5", "CR", "d")] * 40)
    statement = frame("RRN string, AMOUNT string", *[("1", "5")] * 30, ("2", "5"), (None, "5"))
    found = balance.reconcile_balanced("MATM", ledger, statement)
    assert found.rows.count() == 40 * 30 + 2
    assert rows_of(found.table) == sorted(
        [
            ("ledger", "matching_trans", 40),
            ("ledger", "ROWS_IN", 40),
            ("ledger", "ROWS_PLACED", 40),
            ("statement", "matching_trans", 30),
            ("statement", "not_in_ledger", 1),
            ("statement", "UNCLASSIFIED", 1),
            ("statement", "ROWS_IN", 32),
            ("statement", "ROWS_PLACED", 32),
        ],
        key=repr,
    )


def test_a_lost_row_raises(frame, monkeypatch):
    plan = LEDGER_PLANS["MATM"]

    def loses(ledger, statement):
        return plan(ledger, statement.where("RRN <> '2'"))

    monkeypatch.setitem(LEDGER_PLANS, "MATM", loses)
    ledger = frame("UTR string, AMOUNT string, `CR/DR` string, DATE string", ("1", "5", "CR", "d"))
    statement = frame("RRN string, AMOUNT string", ("1", "5"), ("2", "5"), ("2", "6"))
    with pytest.raises(UnbalancedError, match="MATM.*'statement': 2"):
        balance.reconcile_balanced("MATM", ledger, statement)


def test_exception_report_has_unplaced_rows(frame):
    """A settlement that is off by one amount shows its rows."""
    ledger = frame(
        "SNO string, TXNTYPE string, TYPE string, AMOUNT string, DATE string",
        ("5", "x", "credit", "99", "d"),
        ("6", "Bank Settlement", "credit", "9", "d"),
    )
    statement = frame(
        "SETTLED_ID string, AMOUNT string, COMMISSION string, STATUS string",
        ("5", "50", "0", "ok"),
        ("5", "48", "0", "ok"),
    )
    found = reconcile_ledger("AEPS", ledger, statement)
    assert rows_of(found.combined().select("CATEGORY", "AMOUNT_STATEMENT").dropna()) == [
        ("amount_mismatch", 48),
        ("amount_mismatch", 50),
    ]
    assert found.has_exceptions()
    assert "NON_TRANSACTION" in {r["CATEGORY"] for r in found.rows().collect()}
    assert "NON_TRANSACTION" not in {r["CATEGORY"] for r in found.combined().collect()}


def test_bucket_files_follow_the_data(spark, tmp_path):
    """A hot bucket and small ones from 200 partitions: few files, the hot bucket's near the target size."""
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.shuffle.partitions": "200",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 20 < 18, F.lit("hot")).otherwise(F.concat(F.lit("b"), F.col("id") % 20))
        rows = spark.range(0, 200_000, 1, 200).select(hot.alias("CATEGORY"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        sinks.write_buckets(rows, str(tmp_path / "out"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    files = {}
    for folder, _, names in os.walk(tmp_path / "out"):
        for name in names:
            if name.endswith(".parquet"):
                files.setdefault(os.path.basename(folder), []).append(os.path.getsize(os.path.join(folder, name)))
    assert set(files) == {"CATEGORY=hot", "CATEGORY=b18", "CATEGORY=b19"}
    assert 8 < len(files["CATEGORY=hot"]) < 150
    assert len(files["CATEGORY=b18"]) < 15
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000
