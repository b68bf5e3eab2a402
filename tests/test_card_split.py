"""Refunded applications are told apart from the other rows of a card statement, and none is lost."""

from conftest import rows_of
from tallybook.catalog import queries
from tallybook.plans.ledger_amounts import prepare_references


def test_both_parts_of_a_card_statement_have_the_same_columns(frame):
    ledger = frame("`Reference No` string, `UTIITSL Amount` string, `Lot Date` string", ("U1", "5", "d"))
    statement = frame(
        "`Reference No` string, `Res Amount` string, `Trans Date` string, `Payment Status` string",
        (" U1", "5", "d", "Payment Refunded due to Incomplete Application"),
        (" U2", "6", "d", None),
    )
    _, clean, refunded = prepare_references(ledger, statement)
    assert clean.columns == refunded.columns
    assert rows_of(refunded) == [("U1", "5", "d")]
    assert rows_of(clean) == [("U2", "6", "d")]


def test_every_card_statement_row_is_split(spark, source, sf_dir):
    got = rows_of(queries()["constant_split"](spark, sf_dir))
    assert len(got) == source["card_statement"].count()
    assert {refunded for _, refunded in got} == {True, False}
    assert all(ref.startswith("U") for ref, _ in got)
