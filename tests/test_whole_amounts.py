"""Whole amounts are cut from text that is cleaned once."""

from tallybook.functions.numbers import whole_number_text


def test_text_of_a_whole_amount_is_cleaned_once(frame):
    """Once per use of the amount, however many steps the cut takes."""
    df = frame("v string", (" 7.5 ",)).select(whole_number_text("v").alias("w"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("trim(v#") == 1


def test_signs_points_and_line_ends(frame):
    cut = {"+-5": "+-5", "-": "-", ".": ".", "+.5": "0", "-.5": "0", "-0.9": "0", "007.": "7", "1.2.3": "1.2.3"}
    cut |= {"5\u2028": "5\u2028", "\u0665": "5", "-012.5": "-12", "+7": "7", "1x": "1x", "": ""}
    df = frame("v string", *[(t,) for t in cut])
    got = [r[0] for r in df.select(whole_number_text("v")).collect()]
    assert got == list(cut.values())
