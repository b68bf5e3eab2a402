"""Token counts of texts, each different text encoded once.

A cache table holds (content digest, tokenizer digest, count). Texts are reduced to their
digests and joined with it; only one text of each missing digest is encoded, and the new
counts are appended. The tokenizer's digest covers its file and the library's version, so
that a changed tokenizer never finds old counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import new_folder, saved
from tallybook.llm.tokenizing import encoder, tokenizer_digest
from tallybook.operators.match import own_shuffle

LIMIT = 1024
_CACHE = "content string, tokenizer string, n_tokens long"


def content_digest(text: str = "text"):
    """SHA-256 of the whole text in UTF-8, null as empty.

    The tokenizers keep case, white space and code points apart in their own ways, so
    nothing else may be normalised away before counts are shared.
    """
    return F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)


def cached_counts(spark, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of the counts in the folder ``cache`` for this tokenizer."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    table = spark.read.schema(_CACHE).parquet(cache) if there else spark.createDataFrame([], _CACHE)
    return table.where(F.col("tokenizer") == tokenizer).select("content", "n_tokens")


def count_tokens(
    df: DataFrame, path: str, cache: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(id, n_bytes, n_tokens) for each row of ``df``; new counts are appended to ``cache``.

    ``path``: a tokenizer file that every worker has. ``cache``: a folder that all of
    them reach; it need not exist. If a run breaks off before it has appended, the next one
    repeats its work; counts that two runs append at once are equal and do no harm.
    """
    spark, version = df.sparkSession, tokenizer_digest(path)
    source = df.select(
        F.col(f"`{key}`").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        content_digest(text).alias("content"),
    )
    rows = saved(
        source.select("id", "content", F.octet_length("text").cast("long").alias("n_bytes")),
        "digests",
    )
    # of the copies of a missing text, the row with the least key is encoded
    misses = (
        rows.groupBy("content")
        .agg(F.min("id").alias("id"))
        .join(cached_counts(spark, cache, version), "content", "left_anti")
    )
    s, m = source.alias("s"), misses.alias("m")
    texts = s.join(
        m, F.expr("s.content = m.content AND s.id <=> m.id"), "left_semi"
    ).select("content", "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = encoder(path).count
        for b in batches:
            yield pd.DataFrame({"content": b["content"], "n_tokens": [count(t) for t in b["text"]]})

    # rows that share key and text are encoded each, but cached once
    texts.mapInPandas(encode, "content string, n_tokens long").distinct().select(
        "content", F.lit(version).alias("tokenizer"), "n_tokens"
    ).write.mode("append").parquet(cache)
    counts = cached_counts(spark, cache, version).groupBy("content").agg(
        F.max("n_tokens").alias("n_tokens")
    )
    # a text with very many copies: its rows are split over tasks
    return own_shuffle(rows, "content").join(own_shuffle(counts, "content"), "content").select(
        "id", "n_bytes", "n_tokens"
    )


def token_report(
    df: DataFrame,
    path: str,
    cache: str | None = None,
    limit: int = LIMIT,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of ``df``.

    Without ``cache``, one that starts empty is used. Null and empty texts have 0 tokens;
    rows without a key and repeated rows are counted like any other; an empty table gives
    no rows.
    """
    cache = cache or new_folder(df.sparkSession, "token-cache")
    return count_tokens(df, path, cache, text, key).select(
        F.col("id").alias(key),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
