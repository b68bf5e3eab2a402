"""One row per key: first, last, best, and the tie-keeping form.

All of these are aggregations, not windows: a key that holds a large share of
the rows is reduced in every map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col, quoted
from tallybook.operators.match import KeyForm, exact, join_keys, key_set, missing_from

_ROW = "__row"


def _keep(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick_max: bool
) -> DataFrame:
    # The whole row follows the stated order, so that full ties are broken the
    # same way however the input is partitioned.
    rest = [quoted(c) for c in df.columns if c not in keys]
    row = F.struct(*rest)
    rank = F.struct(*order, row)
    best = (F.max_by if pick_max else F.min_by)(row, rank)
    picked = df.groupBy(*map(quoted, keys)).agg(best.alias(_ROW))
    flat = picked.select(*map(quoted, keys), f"{_ROW}.*")
    return flat.select(*map(quoted, df.columns))


def keep_first(df: DataFrame, keys: Sequence[str] | str, *order: Column | str) -> DataFrame:
    """Per key, the row smallest in ``order``. All rows with null keys count as one key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _keep(df, keys, [as_col(o) for o in order], pick_max=False)


def keep_last(df: DataFrame, keys: Sequence[str] | str, *order: Column | str) -> DataFrame:
    """Per key, the row largest in ``order``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _keep(df, keys, [as_col(o) for o in order], pick_max=True)


def keep_newest_with_ties(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """Per key, every row that carries the newest ``stamp``; rows without a key are dropped.

    The newest stamps are joined back on key and stamp together, so rows of a
    hot key are spread over the join by their stamps.
    """
    newest = (
        df.where(as_col(key).isNotNull())
        .groupBy(as_col(key).alias("__key"))
        .agg(F.max(as_col(stamp)).alias("__stamp"))
    )
    same = (as_col(key) == F.col("__key")) & (as_col(stamp) == F.col("__stamp"))
    return df.join(newest, same, "left_semi")


def only_keys_missing_from(
    history: DataFrame,
    wanted: DataFrame,
    present: DataFrame,
    key: str,
    wanted_key: str,
    form: KeyForm = exact,
) -> DataFrame:
    """Rows of the undated ``history`` whose key ``wanted`` asks for and ``present`` does not have."""
    missing = missing_from(wanted, present, wanted_key, key, form)
    return join_keys(history, key_set(missing, wanted_key, form), key, form, "left_semi")
