import datetime as dt

import pytest

from conftest import rows_of
from tallybook.errors import ContractError, UnknownServiceError
from tallybook.functions.dates import in_days
from tallybook.sources import files, sinks
from tallybook.sources.tables import JdbcSource, Tables, is_empty_window, named_query, rows_in_list


def test_csv_keeps_ids_as_text(spark, frame, tmp_path):
    path = str(tmp_path / "f")
    frame("`Ref No` string, Amount string", ("007", "1.0")).write.option("header", True).csv(path)
    df = files.read_csv(spark, path)
    assert df.dtypes == [("Ref No", "string"), ("Amount", "string")]
    assert rows_of(df) == [("007", "1.0")]
    typed = files.read_csv(spark, path, {"Ref No": "string", "Amount": "double"})
    assert rows_of(typed) == [("007", 1.0)]


def test_parquet_and_text_form(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    frame("id int, day date", (1, dt.date(2024, 1, 2))).write.parquet(path)
    assert rows_of(files.as_text(files.read_parquet(spark, path))) == [("1", "2024-01-02")]
    assert rows_of(files.read_parquet(spark, [path], {"id": "int"})) == [(1,)]
    assert files.text_schema(["a b"]).simpleString() == "struct<a b:string>"


def test_contract(frame):
    df = frame("a string, b string", ("1", "2"))
    assert files.require_columns(df, ["a"]) is df
    with pytest.raises(ContractError, match="c, d"):
        files.require_columns(df, ["d", "a", "c"], "ledger")


def test_tables(spark, frame):
    frame("x int", (1,)).createOrReplaceTempView("some_table")
    tables = Tables.from_catalog(spark, {"t": "some_table"})
    assert "t" in tables and tables["t"].count() == 1
    with pytest.raises(UnknownServiceError):
        tables["u"]


def test_jdbc_needs_a_driver_of_the_callers(spark):
    source = JdbcSource("jdbc:nodb://host/db", {"user": "someone"})
    with pytest.raises(Exception, match="(?i)driver"):
        source.table(spark, "t", split_on="id", lower=0, upper=10, parts=2)


def test_named_query_and_list_parameters(spark, frame):
    df = frame("a int, d date", (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1)))
    got = named_query(spark, "SELECT a FROM {t} WHERE d > :day", {"t": df}, day=dt.date(2024, 1, 15))
    assert rows_of(got) == [(2,)]
    assert rows_of(rows_in_list(df, "a", [1, 3]).select("a")) == [(1,)]
    assert rows_of(rows_in_list(df, "a", frame("k int", (2,), (2,))).select("a")) == [(2,)]
    assert is_empty_window(df, in_days("d", "2023-01-01", "2023-12-31"))
    assert not is_empty_window(df, in_days("d", "2024-02-01", "2024-02-01"))


def test_presentable(frame):
    df = frame(
        "CATEGORY string, AMOUNT string, HUB_AMOUNT double, SERVICE_DATE date, n int, x double",
        ("A", "1.23456", 2.00049, dt.date(2024, 1, 2), 3, float("nan")),
        (" ", "text", None, None, None, 1.0),
        ("None", "NaN", float("nan"), None, None, None),
    )
    assert rows_of(sinks.presentable(df)) == sorted(
        [
            ("A", 1.235, 2.0, "2024-01-02", 3, None),
            (None, 0.0, None, None, None, 1.0),
            (None, 0.0, 0.0, None, None, None),
        ],
        key=repr,
    )


def test_bucket_and_sorted_sinks(spark, frame, tmp_path):
    df = frame("CATEGORY string, v int", ("A", 3), ("B", 1), ("A", 2))
    path = str(tmp_path / "b")
    sinks.write_buckets(df, path)
    assert (tmp_path / "b" / "CATEGORY=A").exists()
    assert rows_of(spark.read.parquet(path).select("CATEGORY", "v")) == [("A", 2), ("A", 3), ("B", 1)]
    sinks.write_buckets(df, str(tmp_path / "j"), fmt="json")
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    sinks.write_sorted(df, str(tmp_path / "s"), ["v"], fmt="json")
    assert [r["v"] for r in spark.read.json(str(tmp_path / "s")).collect()] == [1, 2, 3]


def test_staging_uses_the_shared_folder(spark, frame, monkeypatch):
    from tallybook.errors import TallyError
    from tallybook.sources import staging

    df = frame("a int, b string", (1, "x"), (2, None))
    again = staging.staged(df)
    assert rows_of(again) == rows_of(df)
    assert spark.conf.get("spark.checkpoint.dir") in again.inputFiles()[0]
    monkeypatch.setattr(staging, "SETTING", "spark.no.such.setting")
    with pytest.raises(TallyError, match="shared folder"):
        staging.staged(df)
