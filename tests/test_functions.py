import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybook.config.vendor_files import VENDOR_FILES
from tallybook.functions import dates, labels, numbers, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("12.0", "12"),
        ("10.75", "10"),
        ("-3.9", "-3"),
        ("-0.4", "0"),
        ("007", "7"),
        (" 5 ", "5"),
        ("1e3", "1000"),
        ("1d", "1d"),
        ("abc ", "abc"),
        ("nan", ""),
        (" NaN ", ""),
        (None, ""),
        ("", ""),
        ("inf", "inf"),
        ("9007199254740993", "9007199254740993"),
        ("123456789012345678901234", "123456789012345678901234"),
        ("9223372036854775808.0", "9223372036854775808"),
        ("-00012345678901234567890.75", "-12345678901234567890"),
        (".5", "0"),
        ("-1.5e1", "-15"),
        ("1.2e19", "12000000000000000000"),
        ("+7.", "7"),
    ],
)
def test_whole_number_text(frame, raw, expected):
    df = frame("v string", (raw,))
    assert values(df, numbers.whole_number_text("v")) == [expected]


@pytest.mark.parametrize(
    "left, right, equal",
    [
        ("10.004", "10.00", False),
        ("10.0", " 10.000 ", True),
        ("99999999999999999.99", "99999999999999999.990", True),
        ("99999999999999999.99", "99999999999999999.98", False),
        ("abc", "abc", False),
    ],
)
def test_exact_amounts(frame, left, right, equal):
    df = frame("v string, w string", (left, right))
    same = numbers.amounts_equal(numbers.to_decimal("v"), numbers.to_decimal("w"))
    assert values(df, same) == [equal]


@pytest.mark.parametrize(
    "raw, expected",
    [("1.5", False), ("abc", True), ("", False), (" ", False), (None, False), ("1e30", True)],
)
def test_is_unreadable(frame, raw, expected):
    assert values(frame("v string", (raw,)), numbers.is_unreadable("v")) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [("1.5", 1.5), (" 2 ", 2.0), ("1f", None), ("nan", None), ("inf", None), ("x", None), (None, None)],
)
def test_to_number(frame, raw, expected):
    assert values(frame("v string", (raw,)), numbers.to_number("v")) == [expected]


def test_round_result(frame):
    df = frame("v string", ("1.23456",), ("text",), (None,), ("NaN",))
    assert values(df, numbers.round_result("v")) == [1.235, 0.0, None, 0.0]


def test_close_to_is_relative_to_its_base(frame):
    df = frame("a double, b double", (100.0009, 100.0), (100.002, 100.0), (0.0, 0.0))
    assert values(df, numbers.close_to("a", "b")) == [True, False, True]


def test_amounts_equal_counts_null_as_difference(frame):
    df = frame("a double, b double", (1.0, 1.0), (1.0, None), (None, None))
    assert values(df, numbers.amounts_equal("a", "b")) == [True, False, False]


def test_keys(frame):
    df = frame("v string", ("\t a  b \n",), ("  ",), (None,), (" x",))
    assert values(df, text.strip("v")) == ["a  b", "", None, "x"]
    assert values(df, text.squeeze("v")) == ["a b", "", None, "x"]
    assert values(df, text.key_of("v")) == ["a  b", None, None, "x"]


def test_scrub_and_null_words(frame):
    df = frame("v string", ("None",), ("nan",), (" NONE ",), ("x ",), (" ",))
    assert values(df, text.scrub("v")) == [None, None, None, "x ", None]
    assert values(df, text.null_words_to_null("v")) == [None, None, "NONE", "x", ""]


def test_capture_gives_null_without_match(frame):
    df = frame("v string", ("Txnid55 paid",), ("none",), (None,))
    assert values(df, text.capture("v", r"Txnid(\d+)")) == ["55", None, None]


def test_dates(frame):
    df = frame("v string", ("12/31/1999",), ("31121999",), ("junk",), (None,))
    got = values(df, dates.parse_date("v", ("MM/dd/yyyy", "ddMMyyyy")))
    assert got == [dt.date(1999, 12, 31)] * 2 + [None, None]


def test_layouts_differ_in_day_and_month(frame):
    df = frame("v string", ("02/03/2024",))
    assert values(df, dates.parse_date("v", dates.DAY_FIRST_LAYOUTS)) == [dt.date(2024, 3, 2)]
    assert values(df, dates.parse_date("v", dates.MONTH_FIRST_LAYOUTS)) == [dt.date(2024, 2, 3)]


def test_windows(frame):
    stamps = [dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 2)]
    df = frame("t timestamp_ntz", *[(s,) for s in stamps])
    assert values(df, dates.in_days("t", "2024-01-01", "2024-01-31")) == [True, False, False]
    look = dates.in_lookahead("t", "2024-01-01", "2024-02-01", days=30)
    assert values(df, look) == [True, True, True]
    look = dates.in_lookahead("t", "2024-01-01", "2024-02-01", days=30, closed=False)
    assert values(df, look) == [True, True, False]
    assert values(df, dates.in_month_before("t", "2024-02-29")) == [True, False, False]
    assert values(df, dates.in_month_of("t", "2024-02-29")) == [False, True, False]
    assert values(df, dates.after_day("t", "2024-02-01")) == [False, False, True]


def test_month_before_january(frame):
    df = frame("t timestamp_ntz", (dt.datetime(2023, 12, 31, 12),))
    assert values(df, dates.in_month_before("t", "2024-01-15")) == [True]


def test_unknown_codes_pass_through(frame):
    df = frame("c int", (1,), (9,), (None,))
    assert values(df, labels.label("c", labels.HUB_STATUS)) == ["success", "9", None]
    assert values(df, labels.centre_type("c")) == ["Jenseva Kendra", "EBO", "EBO"]


@pytest.mark.parametrize(
    "service, word, expected",
    [
        ("BBPS", "Successful", "success"),
        ("BBPS", "Transaction timed out", "timed out"),
        ("BBPS", "", "failed"),
        ("BBPS", None, "failed"),
        ("ASTRO", "Rolled Back", "initiated"),
        ("ASTRO", "else", "failed"),
        ("DMT", "Refunded", "failed"),
        ("DMT", "Success", "success"),
        ("MOVETOBANK", "PROCESSED", "success"),
        ("MOVETOBANK", "processed", "failed"),
        ("PANUTI", "was REFUNDED", "failed"),
        ("PANUTI", None, "success"),
        ("PANNSDL", "Accepted", "success"),
        ("PANNSDL", None, "failed"),
        ("MATM", "x AUTH_SUCCESS", "success"),
        ("MATM", None, "failed"),
        ("UPIQR", "Authorised", "success"),
        ("UPIQR", " Authorised", "failed"),
        ("RECHARGE", " success ", "success"),
        ("IMPS", " success ", " success "),
    ],
)
def test_vendor_status_rules(frame, service, word, expected):
    df = frame("s string", (word,))
    assert values(df, VENDOR_FILES[service].status.apply("s")) == [expected]


def test_column_names_with_dots_and_spaces(frame):
    df = frame("`Tkt. No` string", (" a ",))
    assert values(df, text.strip("Tkt. No")) == ["a"]
    assert values(df, F.upper(text.strip("Tkt. No"))) == ["A"]
