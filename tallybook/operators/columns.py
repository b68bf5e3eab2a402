"""Projection helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import quoted


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[quoted(n) for n in names if n in present])


def rename_existing(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Old name to new name; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def upper_headers(df: DataFrame) -> DataFrame:
    """Column names stripped and upper-cased."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column missing on one side is null there."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    )


def tagged(df: DataFrame, category: str) -> DataFrame:
    """``df`` with its bucket name in front."""
    return df.select(F.lit(category).alias("CATEGORY"), *map(quoted, df.columns))


def label_all(df: DataFrame, **labels: str) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in labels.items()})
