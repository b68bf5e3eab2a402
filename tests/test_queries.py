"""Every registered query against its SQL in another engine, over whole tables."""

import pytest

from compare import compare, connect
from tallybook.catalog import oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert len(rows) == 15 and all(r["n"] > 0 for r in rows)



@pytest.mark.parametrize(
    "name, column, expected",
    [
        ("recon_rows", "CATEGORY", 15),
        ("upi_buckets", "CATEGORY", 10),
        ("imps_buckets", "CATEGORY", 9),
        ("up_buckets_sultanpursca", "CATEGORY", 4),
        ("up_buckets_manual_tb", "CATEGORY", 4),
        ("refund_reconcile", "CATEGORY", 5),
        ("settlement_reconcile", "CATEGORY", 5),
        ("amount_reconcile", "CATEGORY", 4),
        ("bill_reconcile", "CATEGORY", 7),
        ("commission_reconcile", "CATEGORY", 5),
        ("daily_verdict_rows", "CATEGORY", 3),
        ("users_lists", "LIST", 6),
    ],
)
def test_every_bucket_occurs(spark, sf_dir, name, column, expected):
    assert queries()[name](spark, sf_dir).select(column).distinct().count() == expected
