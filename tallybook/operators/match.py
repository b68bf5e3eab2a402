"""Equi-matching of two sides on a reference.

Null keys never match. Membership tests (semi, anti, flag) reduce the right
side to its distinct keys before the join: repeats of a hot key collapse in the
map-side half of that aggregation, and the join itself can only be skewed on
its left, which adaptive execution splits. It can do so only if both sides
arrive through a shuffle made for the join, see ``key_set``. No side is ever
hinted for broadcast; Spark broadcasts what its statistics show to be small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.errors import DuplicateKeyError
from tallybook.functions._cols import as_col
from tallybook.functions.labels import yes_no
from tallybook.functions.text import key_of

KeyForm = Callable[[str], Column]
_KEY = "__key"
_HIT = "__hit"


def exact(name: str) -> Column:
    """Key compared as stored."""
    return as_col(name)


def stripped(name: str) -> Column:
    """Key compared without surrounding white space; a blank key is no key."""
    return key_of(name)


def key_set(df: DataFrame, key: str, form: KeyForm = stripped) -> DataFrame:
    """Distinct usable keys of a side, as the single column ``__key``."""
    return distinct_keys(df.select(form(key).alias(_KEY)))


def distinct_keys(keys: DataFrame) -> DataFrame:
    """Distinct non-null values of ``__key``, ready to be the right side of a join."""
    return own_shuffle(keys.where(F.col(_KEY).isNotNull()).distinct(), _KEY)


def own_shuffle(grouped: DataFrame, key: str) -> DataFrame:
    """A frame grouped by ``key`` that does not offer its partitioning to a join on it.

    Left alone, Spark would join the output of the aggregation in place. That
    saves a shuffle of the reduced rows, but adaptive execution then cannot
    split a hot key, or a mass of null keys, on the other and much larger side.
    ``greatest`` of the key with itself is the key, yet hides the partitioning,
    so the join gets a shuffle of its own.
    """
    return grouped.withColumn(key, opaque(key))


def opaque(key: str) -> Column:
    """The key itself, in a form that does not show how its frame is partitioned."""
    return F.greatest(as_col(key), as_col(key))


def join_keys(
    left: DataFrame, keys: DataFrame, left_key: str, form: KeyForm, how: str
) -> DataFrame:
    """Join ``left`` to a frame that carries ``__key``.

    The key is an expression over the left column, not a new column, so that a
    chain of joins on one key shuffles the left side once.
    """
    return left.join(keys, form(left_key) == F.col(_KEY), how).drop(_KEY)


def inner_match(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    form: KeyForm = stripped,
    null_keys_match: bool = False,
) -> DataFrame:
    """All pairs with equal keys. Repeated keys multiply, as in any join.

    Column names of the two sides must not overlap. ``null_keys_match`` also
    pairs null with null. It exists for parity with tools that do so and should
    stay off: such pairs mean nothing and all land on one key.
    """
    overlap = sorted(set(left.columns) & set(right.columns))
    if overlap:
        raise ValueError(f"both sides have column(s) {', '.join(overlap)}")
    a, b = form(left_key), form(right_key)
    return left.join(right, a.eqNullSafe(b) if null_keys_match else a == b, "inner")


def missing_from(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    form: KeyForm = stripped,
) -> DataFrame:
    """Left rows without a partner; rows without a usable key are always included."""
    return join_keys(left, key_set(right, right_key, form), left_key, form, "left_anti")


def present_in(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    form: KeyForm = stripped,
) -> DataFrame:
    """Left rows that have a partner, each once."""
    return join_keys(left, key_set(right, right_key, form), left_key, form, "left_semi")


def flag_present(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    name: str,
    form: KeyForm = exact,
) -> DataFrame:
    """``Yes``/``No`` column telling whether the key occurs on the right; row count unchanged."""
    hits = key_set(right, right_key, form).withColumn(_HIT, F.lit(True))
    return (
        join_keys(left, hits, left_key, form, "left")
        .withColumn(name, yes_no(F.col(_HIT)))
        .drop(_HIT)
    )


def drop_explained(
    left: DataFrame,
    *explained: tuple[DataFrame, str],
    key: str,
    form: KeyForm = exact,
) -> DataFrame:
    """Left rows whose key no ``(frame, key column)`` of ``explained`` holds: one anti join for all."""
    keys = None
    for frame, column in explained:
        part = frame.select(form(column).alias(_KEY))
        keys = part if keys is None else keys.unionByName(part)
    return join_keys(left, distinct_keys(keys), key, form, "left_anti")


def outer_split(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    form: KeyForm = stripped,
) -> tuple[DataFrame, DataFrame]:
    """``(left only, right only)`` of a full outer join, as two anti joins that can be split on skew."""
    return (
        missing_from(left, right, left_key, right_key, form),
        missing_from(right, left, right_key, left_key, form),
    )


def three_way(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    form: KeyForm = stripped,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(pairs, left only, right only)``.

    Rows without a usable key are set aside first. They need no shuffle, and
    the rest of a side then reaches the match and its anti join through the same
    shuffle, which Spark runs once if both read the same columns.
    """
    usable_left, usable_right = form(left_key).isNotNull(), form(right_key).isNotNull()
    l, r = left.where(usable_left), right.where(usable_right)
    pairs = inner_match(l, r, left_key, right_key, form)
    left_only = missing_from(l, r, left_key, right_key, form)
    right_only = missing_from(r, l, right_key, left_key, form)
    return (
        pairs,
        left_only.unionByName(left.where(~usable_left)),
        right_only.unionByName(right.where(~usable_right)),
    )


def lookup(
    left: DataFrame,
    dimension: DataFrame,
    left_key: str,
    dimension_key: str,
    how: str = "left",
) -> DataFrame:
    """Join to a dimension on exact keys; the dimension's key column is dropped."""
    dim = dimension.withColumnRenamed(dimension_key, _KEY)
    return join_keys(left, dim, left_key, exact, how)


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Repeated non-null keys with their row counts: the data-quality frame of a match."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.where(F.coalesce(*[as_col(k) for k in keys]).isNotNull())
        .groupBy(*[as_col(k) for k in keys])
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > 1)
    )


def assert_unique(df: DataFrame, key: str, side: str = "input") -> None:
    """Raise if a non-null key repeats. Runs one aggregation and fetches at most three keys."""
    repeats = duplicate_keys(df, key).take(3)
    if repeats:
        sample = ", ".join(f"{r[0]} ({r['rows']} rows)" for r in repeats)
        raise DuplicateKeyError(f"{side}: column {key} repeats, e.g. {sample}")


def unique_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    validate: bool = True,
) -> DataFrame:
    """Left join that must be one-to-one; keeps the right key column.

    ``validate=False`` skips the two checking jobs where the caller knows both
    sides to be unique, for example because they were just grouped by the key.
    """
    if validate:
        assert_unique(left, left_key, "left side")
        assert_unique(right, right_key, "right side")
    return left.join(right, as_col(left_key) == as_col(right_key), "left")
