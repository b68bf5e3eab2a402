"""Internal tables: catalog, JDBC, or frames handed over by the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.errors import UnknownServiceError
from tallybook.functions._cols import as_col
from tallybook.operators.match import present_in


@dataclass(frozen=True)
class JdbcSource:
    """Connection of the caller's making; nothing about it is stored here.

    With ``split_on`` the read is cut into ``parts`` range queries that run in
    parallel on the executors. Column pruning and window predicates are pushed
    into each of them.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def table(
        self,
        spark: SparkSession,
        name: str,
        split_on: str | None = None,
        lower: object = None,
        upper: object = None,
        parts: int = 64,
    ) -> DataFrame:
        reader = (
            spark.read.format("jdbc")
            .options(**self.options)
            .option("url", self.url)
            .option("dbtable", name)
            .option("fetchsize", self.fetch_size)
        )
        if split_on:
            reader = (
                reader.option("partitionColumn", split_on)
                .option("lowerBound", str(lower))
                .option("upperBound", str(upper))
                .option("numPartitions", parts)
            )
        return reader.load()


class Tables:
    """The internal tables a plan reads, by logical name.

    ``Tables(master=df, wallet=df)`` wraps frames;
    ``Tables.from_catalog(spark, {"master": "core.master_txn"})`` reads the
    catalog lazily.
    """

    def __init__(self, **frames: DataFrame):
        self._frames = dict(frames)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Tables:
        return cls(**{k: spark.table(v) for k, v in names.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            raise UnknownServiceError(f"no table registered as '{name}'")
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in self._frames


def named_query(
    spark: SparkSession, text: str, frames: Mapping[str, DataFrame] | None = None, **params
) -> DataFrame:
    """SQL text with ``:name`` parameters; ``{name}`` in it stands for a frame."""
    return spark.sql(text, args=params or None, **(frames or {}))


def rows_in_list(
    df: DataFrame, column: str, values: Sequence[object] | DataFrame
) -> DataFrame:
    """``IN`` with a parameter list, or with the first column of a frame (a semi join)."""
    if isinstance(values, DataFrame):
        return present_in(df, values, column, values.columns[0], form=as_col)
    return df.where(as_col(column).isin(*values))


def is_empty_window(df: DataFrame, in_window) -> bool:
    """Whether no row falls in the window. Runs a job that stops at the first hit."""
    return df.where(in_window).select(F.lit(1)).isEmpty()
