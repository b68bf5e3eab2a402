"""Result shaping and writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions._cols import as_col, quoted
from tallybook.functions.dates import date_text
from tallybook.functions.numbers import round_result
from tallybook.functions.text import scrub

# Amount columns that are rounded to three places in every result.
ROUNDED_COLUMNS = ("AMOUNT", "COMMISSION_AMOUNT", "HUB_AMOUNT")

_STAMPS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def presentable(df: DataFrame, rounded: Sequence[str] = ROUNDED_COLUMNS) -> DataFrame:
    """Amounts rounded, dates as ``yyyy-MM-dd`` text, placeholder nulls and NaN made null."""

    def shape(field: T.StructField):
        c = as_col(field.name)
        if field.name in rounded:
            return F.nanvl(round_result(c), F.lit(None).cast("double"))
        if isinstance(field.dataType, _STAMPS):
            return date_text(c)
        if isinstance(field.dataType, T.StringType):
            return scrub(c)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.nanvl(c, F.lit(None).cast(field.dataType))
        return c

    return df.select(*[shape(f).alias(f.name) for f in df.schema.fields])


def write_buckets(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """One directory per bucket, in files near the size that adaptive execution aims at.

    The rows are rebalanced by bucket: a bucket that holds most rows is split over many tasks, and small
    ones are put together, so that the number of files follows the data and not the number of
    tasks times the number of buckets. Without adaptive execution each bucket is one file.
    """
    df = df.hint("rebalance", F.col("CATEGORY"))
    df.write.mode(mode).partitionBy("CATEGORY").format(fmt).save(path)


def write_sorted(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Rows in global order, range-partitioned over the output files."""
    df.orderBy(*map(quoted, by)).write.mode(mode).format(fmt).save(path)
