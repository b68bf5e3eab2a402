"""Vendor files. Spreadsheets are converted to CSV or Parquet upstream; ids stay text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.errors import ContractError
from tallybook.functions._cols import quoted

Schema = T.StructType | Mapping[str, str]

#: Column with the lines that do not fit their file's schema.
MALFORMED = "_malformed"


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def to_schema(schema: Schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType(
        [T.StructField(n, T.DataType.fromDDL(t)) for n, t in schema.items()]
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    keep_malformed: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV, with a header unless told otherwise. Without a schema every column is text; types are never guessed.

    ``keep_malformed``, with a schema: the column ``MALFORMED`` holds the line where it has too few
    or too many fields or a value that is not of its column's type, and is null elsewhere,
    whichever columns are read. Without it, what is missing or of another type is null.
    """
    reader = spark.read.option("header", header).option("enforceSchema", False)
    if not keep_malformed:
        return (reader if schema is None else reader.schema(to_schema(schema))).csv(path)
    if schema is None:
        raise ContractError("lines can only be checked against a schema")
    fields = to_schema(schema).fields
    text = text_schema(f.name for f in fields).add(MALFORMED, T.StringType())
    # a parser that is told to read some columns only does not notice missing or further ones, and
    # types only the columns it reads, so the types are applied here
    reader = reader.schema(text).option("columnPruning", False)
    lines = reader.option("columnNameOfCorruptRecord", MALFORMED).option("mode", "PERMISSIVE").csv(path)
    columns = [F.col(quoted(f.name)) for f in fields]
    typed = [c.try_cast(f.dataType) for c, f in zip(columns, fields)]
    wrong = [c.isNotNull() & t.isNull() for c, t in zip(columns, typed)]
    unfit = F.when(reduce(or_, wrong), F.to_csv(F.struct(*columns)))
    return lines.select(
        *[t.alias(f.name) for t, f in zip(typed, fields)],
        F.coalesce(F.col(MALFORMED), unfit).alias(MALFORMED),
    )


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: Schema | None = None
) -> DataFrame:
    """Parquet (one or more paths), optionally with a declared schema."""
    paths = [path] if isinstance(path, str) else path
    reader = spark.read if schema is None else spark.read.schema(to_schema(schema))
    return reader.parquet(*paths)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the form in which vendor files are reconciled."""
    return df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in df.columns])


def require_columns(df: DataFrame, names: Iterable[str], what: str = "file") -> DataFrame:
    """``df`` itself, or ``ContractError`` if columns are missing. Starts no job."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError(f"{what}: missing column(s) {', '.join(missing)}")
    return df
