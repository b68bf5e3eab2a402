import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallybook.errors import DuplicateKeyError
from tallybook.operators import latest, match, wallet
from tallybook.operators.columns import select_existing, union_aligned, upper_headers
from tallybook.operators.filters import drop_all_null, exclude_matching, split_on
from tallybook.operators.rules import LEDGER_RULES, QR_RULES, TRANSFER_RULES, classify
from tallybook.operators.summary import match_summary, pair_counts
from tallybook.plans.hub_recon import buckets


@pytest.fixture
def sides(frame):
    left = frame("k string, a int", ("x", 1), ("x", 2), (" y ", 3), (None, 4), ("", 5), ("q", 6))
    right = frame("r string, b int", ("x", 10), ("x", 20), ("y", 30), (None, 40), ("z", 50))
    return left, right


def test_inner_match_multiplies_repeats_and_skips_nulls(sides):
    pairs = match.inner_match(*sides, "k", "r")
    assert rows_of(pairs.select("a", "b")) == [(1, 10), (1, 20), (2, 10), (2, 20), (3, 30)]


def test_inner_match_exact_does_not_strip(sides):
    pairs = match.inner_match(*sides, "k", "r", match.exact)
    assert (3, 30) not in rows_of(pairs.select("a", "b"))


def test_null_keys_match_on_request(sides):
    pairs = match.inner_match(*sides, "k", "r", match.exact, null_keys_match=True)
    assert (4, 40) in rows_of(pairs.select("a", "b"))


def test_inner_match_refuses_shared_names(frame):
    df = frame("k string", ("x",))
    with pytest.raises(ValueError):
        match.inner_match(df, df, "k", "k")


def test_missing_rows_include_unusable_keys(sides):
    left, right = sides
    assert rows_of(match.missing_from(left, right, "k", "r").select("a")) == [(4,), (5,), (6,)]
    assert rows_of(match.missing_from(right, left, "r", "k").select("b")) == [(40,), (50,)]


def test_membership_keeps_row_count(sides):
    left, right = sides
    assert rows_of(match.present_in(left, right, "k", "r").select("a")) == [(1,), (2,), (3,)]
    flagged = match.flag_present(left, right, "k", "r", "HIT", match.stripped)
    assert flagged.count() == 6
    assert flagged.where("HIT = 'Yes'").count() == 3


def test_unique_left_join_raises_on_repeats(sides):
    left, right = sides
    with pytest.raises(DuplicateKeyError, match="left side.*k repeats"):
        match.unique_left_join(left, right, "k", "r")
    once = right.where("b <> 20")
    with pytest.raises(DuplicateKeyError):
        match.unique_left_join(left, once, "k", "r")
    joined = match.unique_left_join(left.where("a <> 2"), once, "k", "r")
    assert joined.count() == 5


def test_duplicate_keys_ignores_null(sides):
    assert rows_of(match.duplicate_keys(sides[0], "k")) == [("x", 2)]


def test_drop_explained(sides, frame):
    left, right = sides
    other = frame("o string", ("q",))
    rest = match.drop_explained(left, (right, "r"), (other, "o"), key="k", form=match.stripped)
    assert rows_of(rest.select("a")) == [(4,), (5,)]


def all_statuses(frame):
    v = ["success", "failed", "timed out", "other", None]
    h = ["success", "failed", "initiated", "inprogress", "pending", "partial success", None]
    led = ["Yes", "no", None]
    return frame(
        "v string, h string, l string", *[(a, b, c) for a in v for b in h for c in led]
    )


@pytest.mark.parametrize("rules, ledger", [(LEDGER_RULES, "l"), (TRANSFER_RULES, None), (QR_RULES, None)])
def test_rules_exclude_each_other(frame, rules, ledger):
    df = all_statuses(frame)
    hits = sum(
        (
            (rule.vendor_test(F.lower("v")) & rule.hub_test(F.lower("h"), F.lower("l"))).cast("int")
            for rule in rules
        ),
        start=F.lit(0),
    )
    assert df.where(hits > 1).count() == 0
    bucket = classify(rules, "v", "h", ledger)
    assert df.where((hits == 0) != (bucket == "UNCLASSIFIED")).count() == 0
    assert df.select(bucket.alias("c")).distinct().count() == len(rules) + 1


def test_late_success_without_ledger_is_unclassified(frame):
    df = frame("v string, h string, l string", ("timed out", "success", "No"), ("timed out", "success", "YES"))
    got = [r[0] for r in df.select(classify(LEDGER_RULES, "v", "h", "l")).collect()]
    assert got == ["UNCLASSIFIED", "VEND_FAIL_IHUB_SUC"]


@pytest.mark.parametrize("mode", ["strip", "reference"])
def test_summary_equals_counting_the_rows(source, mode):
    hub, vendor = source["hub"], source["vendor"]
    counts = {r["metric"]: r["value"] for r in match_summary(hub, vendor, LEDGER_RULES, key_mode=mode).collect()}
    rows = buckets(hub, vendor, ["REFID"], LEDGER_RULES, key_mode=mode)
    sizes = {r["CATEGORY"]: r["n"] for r in rows.groupBy("CATEGORY").agg(F.count("*").alias("n")).collect()}
    for name, n in sizes.items():
        assert counts[name] == n, name
    assert counts["matched"] == sum(n for c, n in sizes.items() if not c.startswith("NOT_IN"))


def test_every_vendor_row_is_matched_or_missing(source):
    hub, vendor = source["hub"], source["vendor"]
    matched = match.present_in(vendor, hub, "REFID", "VENDOR_REFERENCE").count()
    missing = match.missing_from(vendor, hub, "REFID", "VENDOR_REFERENCE").count()
    assert matched + missing == vendor.count()


def test_summary_of_empty_sides(frame):
    hub = frame("VENDOR_REFERENCE string, IHUB_MASTER_STATUS string, IHUB_LEDGER_STATUS string")
    vendor = frame("REFID string, VENDOR_STATUS string", ("a", "success"), (None, "failed"))
    got = {r["metric"]: r["value"] for r in match_summary(hub, vendor, LEDGER_RULES).collect()}
    assert got["NOT_IN_PORTAL"] == 2 and got["matched"] == 0 and got["HUB_Value_count"] == 0


def test_pair_counts(sides):
    every = F.lit(True)
    left, right = sides
    pairs = {"all": (every, every), "some": (F.col("a") > 1, F.col("b") > 10)}
    got = {r[0]: r[1] for r in pair_counts(left, right, "k", "r", pairs, match.stripped).collect()}
    assert got == {"all": 5, "some": 2}


def test_latest_rows(frame):
    df = frame(
        "k string, id int, ts int, v string",
        ("a", 1, 5, "x"), ("a", 2, 5, "y"), ("a", 3, 4, "z"), (None, 4, 1, "p"), (None, 5, 2, "q"),
    )
    assert rows_of(latest.keep_first(df, "k", "id").select("id")) == [(1,), (4,)]
    assert rows_of(latest.keep_last(df, "k", "id").select("id")) == [(3,), (5,)]
    assert rows_of(latest.keep_newest_with_ties(df, "k", "ts").select("id")) == [(1,), (2,)]


def test_keep_first_does_not_depend_on_partitioning(source):
    df = source["wallet"].select("VendorReferenceId", "ServiceName", "Description", "DebitAmount")
    one = latest.keep_first(df.coalesce(1), "VendorReferenceId", "ServiceName")
    many = latest.keep_first(df.repartition(13, "DebitAmount"), "VendorReferenceId", "ServiceName")
    assert rows_of(one) == rows_of(many)


def test_null_id_rows_are_folded_not_lost(frame):
    flags = "TRANSACTION_CREDIT string, TRANSACTION_DEBIT string, COMMISSION_CREDIT string, COMMISSION_REVERSAL string"
    df = frame(
        f"IHubReferenceId string, MasterTransactionsId bigint, {flags}",
        ("A", None, "Yes", "No", "No", "No"),
        ("A", 7, "No", "Yes", "No", "No"),
        ("B", None, "No", "No", "Yes", "No"),
    )
    assert rows_of(wallet.fold_null_ids(df)) == [
        ("A", 7, "Yes", "Yes", "No", "No"),
        ("B", None, "No", "No", "Yes", "No"),
    ]


def test_column_helpers(frame):
    df = frame("` a ` int, b int", (1, 2))
    assert upper_headers(df).columns == ["A", "B"]
    assert select_existing(df, ["b", "nope", " a "]).columns == ["b", " a "]
    both = union_aligned(frame("x int", (1,)), frame("y int", (2,)))
    assert rows_of(both) == [(1, None), (None, 2)]


def test_null_sensitive_filters(frame):
    df = frame("a string, b string", (None, None), ("x", None), (None, "Bank Settlement"))
    assert drop_all_null(df, ["a", "b"]).count() == 2
    assert drop_all_null(df, ["a", "missing"]).count() == 3
    assert exclude_matching(df, "b", "(?i)settlement").count() == 2
    yes, no = split_on(df, F.col("a") == "x")
    assert (yes.count(), no.count()) == (1, 2)
