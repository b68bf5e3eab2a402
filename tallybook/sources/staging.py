"""Intermediate results in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallybook.errors import TallyError

SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the session names; it must be reachable by all executors."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise TallyError(f"{SETTING} is not set; staging needs a shared folder")
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read back.

    Later plans start from the files: they scan only the columns they need, and
    a lost executor costs a re-read instead of the whole lineage. The files are
    left for the folder's own retention to remove. Zstandard, because a plan often writes more
    than it reads back.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/tallybook/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
