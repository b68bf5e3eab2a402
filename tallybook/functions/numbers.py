"""Amount parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col, once
from tallybook.functions.text import strip

# Java reads a trailing type letter as part of a number; here it is text.
_TYPE_LETTERS = ("d", "D", "f", "F")
# Digits with at most one point and one sign.
_PLAIN_NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"


def to_number(c: ColumnOrName) -> Column:
    """Double from text; anything that is not a finite plain number is null, never an error."""
    text = strip(c)
    value = text.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    plain = ~F.right(text, F.lit(1)).isin(*_TYPE_LETTERS)
    return F.when(finite & plain, value)


def to_decimal(c: ColumnOrName, precision: int = 38, scale: int = 18) -> Column:
    """Exact amount for sums and equality; bad text is null.

    Nothing is rounded to cents: up to 20 digits before and 18 after the point are
    kept. An amount that does not fit is null, see ``is_unreadable``.
    """
    return strip(c).try_cast(f"decimal({precision},{scale})")


def is_unreadable(c: ColumnOrName) -> Column:
    """True for a value that is present but gives no exact amount; false for null and blank."""
    return F.coalesce((strip(c) != "") & to_decimal(c).isNull(), F.lit(False))


def is_bad_number(c: ColumnOrName) -> Column:
    """True for a value that is present but not numeric, for routing rows to a reject bucket."""
    return strip(c).isNotNull() & (strip(c) != "") & to_number(c).isNull()


def whole_number_text(c: ColumnOrName) -> Column:
    """Integer text of a numeric cell, truncated toward zero.

    ``12.0`` gives ``12``, ``10.75`` gives ``10``, null and ``nan`` give the
    empty string. Other text is only stripped. Plain numbers of any length are cut
    as text, so that no digit is lost; only exponent forms are computed, up to 38 digits.
    """
    return once(strip(c), _cut_to_units)


def _cut_to_units(text: Column) -> Column:
    # one pattern tells plain numbers, whose sign and leading zeros are then cut off as text
    plain = text.rlike(_PLAIN_NUMBER)
    units = F.ltrim(F.substring_index(F.ltrim(text, F.lit("+-")), ".", 1), F.lit("0"))
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    cut = F.when(units == "", F.lit("0")).otherwise(F.concat(sign, units))
    value = text.try_cast("decimal(38,18)")
    computed = F.coalesce(
        F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("string"),
        text.try_cast("decimal(38,0)").cast("string"),
    )
    return (
        F.when(text.isNull() | (F.lower(text) == "nan"), F.lit(""))
        .when(plain, cut)
        .otherwise(F.coalesce(computed, text))
    )


def round_result(c: ColumnOrName, places: int = 3) -> Column:
    """Rounded amount for output: null stays null, text that is no number becomes 0.0."""
    col = as_col(c)
    return F.when(col.isNotNull(), F.coalesce(F.round(to_number(col), places), F.lit(0.0)))


def amounts_equal(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Equality in which a null on either side counts as a difference."""
    return F.coalesce(as_col(left) == as_col(right), F.lit(False))


def close_to(
    value: ColumnOrName, base: ColumnOrName, rel: float = 1e-5, abs_: float = 1e-5
) -> Column:
    """Tolerant equality; the relative part is taken of ``base``, so the sides are not symmetric."""
    return F.abs(as_col(value) - as_col(base)) <= F.lit(abs_) + F.lit(rel) * F.abs(
        as_col(base)
    )
