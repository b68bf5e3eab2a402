"""Text and key cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col

# Characters removed from both ends of a key or status.
EDGE_SPACE = " \t\n\r\x0b\x0c\u00a0"

# Spellings of "no value" met on join keys and in results.
KEY_NULL_WORDS = ("None", "nan", "NULL")
RESULT_NULL_WORDS = ("nan", "none", "")


def strip(c: ColumnOrName) -> Column:
    """Text without surrounding white space of any kind; null stays null."""
    return F.btrim(as_col(c).cast("string"), F.lit(EDGE_SPACE))


def squeeze(c: ColumnOrName) -> Column:
    """``strip`` plus every inner run of white space reduced to one space."""
    return F.regexp_replace(strip(c), r"\s+", " ")


def char_slice(c: ColumnOrName, start: int, length: int) -> Column:
    """``length`` characters from the 1-based position ``start``."""
    return F.substring(as_col(c).cast("string"), start, length)


def key_of(c: ColumnOrName) -> Column:
    """Join key form of a reference: stripped text, blank becomes null."""
    text = strip(c)
    return F.when(text != "", text)


def is_present(c: ColumnOrName) -> Column:
    """True for a value that is neither null nor blank."""
    return key_of(c).isNotNull()


def null_words_to_null(
    c: ColumnOrName, words: Iterable[str] = KEY_NULL_WORDS
) -> Column:
    """Stripped text, with placeholder spellings of null (exact case) made null."""
    text = strip(c)
    return F.when(text.isin(*words), F.lit(None)).otherwise(text)


def scrub(c: ColumnOrName) -> Column:
    """Result cleaning: any-case ``nan``/``none`` and blanks become null, others are kept as is."""
    col = as_col(c)
    return F.when(F.lower(strip(col)).isin(*RESULT_NULL_WORDS), F.lit(None)).otherwise(
        col
    )


def strip_currency(c: ColumnOrName, symbol: str = "₹") -> Column:
    """Amount text without the currency symbol and without any spaces."""
    return strip(F.translate(as_col(c).cast("string"), symbol + " ", ""))


def drop_point_zero(c: ColumnOrName) -> Column:
    """Text without one trailing ``.0``; null becomes the empty string."""
    return F.regexp_replace(
        F.coalesce(as_col(c).cast("string"), F.lit("")), r"\.0$", ""
    )


def capture(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """Regex group, null where the pattern does not match (or the group is empty)."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def last_token(c: ColumnOrName, separator: str = "-") -> Column:
    """The part after the last ``separator``."""
    return F.substring_index(as_col(c), separator, -1)


def matches(c: ColumnOrName, pattern: str, when_null: bool = False) -> Column:
    """Regex test with an explicit answer for null input."""
    return F.coalesce(as_col(c).rlike(pattern), F.lit(when_null))


def like_text(c: ColumnOrName, pattern: str, case_sensitive: bool = False) -> Column:
    """SQL ``LIKE``; case-insensitive unless asked otherwise, as the source database compares."""
    col = as_col(c)
    return col.like(pattern) if case_sensitive else col.ilike(pattern)
