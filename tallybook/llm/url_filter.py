"""URLs judged by rules, and the rest by two character language models.

One Markov model is trained on the URLs that rules accept, one on those they reject. Each
predicts a character from contexts of up to five characters and falls back on shorter
ones as far as a context is new (Witten-Bell smoothing), so its order varies from
character to character. A URL is blocked if the difference of its log-likelihoods, by
its length, lies on the far side of a threshold calibrated on URLs that the models have
not seen. The models are a table with a row for each context, which grows with the URLs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.shared import fresh, saved
from tallybook.operators.match import own_shuffle

ALLOW, BLOCK = "allow", "block"
# Rules (host and path, verdict).
RULES = (
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
)
ORDER = 5
SYMBOLS = 64
#: Bits of a symbol: a character and the five before it are one number.
_BITS = 6
#: Every fifth URL by its hash calibrates, the others train.
FOLDS = 5
_STEPS = 400
_LIMIT = 4.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BEGIN = 0
#: Letters, digits and common signs have a symbol each; other bytes share the last ones.
_SYMBOL = np.array(
    [
        1 + (_LOWER + "0123456789./-_?=&#%:~+,;@!").find(chr(b).lower())
        if chr(b).lower() in _LOWER + "0123456789./-_?=&#%:~+,;@!"
        else 53 + b % 11
        for b in range(256)
    ],
    np.int64,
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, owner) of all characters of ``urls``.

    A gram is the symbol and, in higher bits, the five before it, the last one lowest; zeros
    stand before the beginning of the URL.
    """
    data = [u.encode("utf-8", "surrogatepass") for u in urls]
    sizes = np.array([len(d) for d in data], np.int64)
    symbols = _SYMBOL[np.frombuffer(b"".join(data), np.uint8)]
    owner = np.repeat(np.arange(len(data)), sizes)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = symbols.copy()
    for k in range(1, ORDER + 1):
        before = np.full(len(symbols), _BEGIN, np.int64)
        before[k:] = symbols[:-k]
        before[place < k] = _BEGIN
        found |= before << _BITS * k
    return found, owner


def gram_table(rows: DataFrame) -> DataFrame:
    """(row, side, gram, n) of rows (row, side, url): how often each URL has each gram."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found, owner = grams([u or "" for u in b["url"]])
            own = pd.DataFrame({"at": owner, "gram": found}).value_counts(sort=False).reset_index(name="n")
            at = own.pop("at").to_numpy()
            own.insert(0, "side", b["side"].astype("Int32").array[at])
            own.insert(0, "row", b["row"].to_numpy()[at])
            yield own

    return rows.select("row", "side", "url").mapInPandas(count, "row long, side int, gram long, n long")


def _by_order(rows: DataFrame) -> DataFrame:
    """``rows`` (gram, ..) once for each order k, with the context's key and the symbol."""
    gram = F.col("gram")
    keys = [
        F.struct(
            F.lit(k).alias("k"),
            F.shiftright(gram, _BITS)
            .bitwiseAND(F.lit((1 << _BITS * k) - 1).cast("long"))
            .bitwiseOR(F.lit(k << _BITS * ORDER).cast("long"))
            .alias("key"),
        )
        for k in range(ORDER + 1)
    ]
    return rows.withColumn("x", F.explode(F.array(*keys))).select(
        *rows.columns, "x.k", "x.key", gram.bitwiseAND((1 << _BITS) - 1).cast("int").alias("symbol")
    )


def context_table(table: DataFrame) -> DataFrame:
    """A row for each context of ``table`` (side, gram, n): what follows it, by side.

    (key, total, kinds, counts): arrays of the two sides, and their counts by symbol.
    """
    whole = table.groupBy("gram").agg(
        *(F.sum(F.when(F.col("side") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in (0, 1))
    )
    cells = _by_order(whole).groupBy("key", "symbol").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sides = ("n0", "n1")
    # at most one entry for each symbol
    return cells.groupBy("key").agg(
        F.array(*(F.sum(n) for n in sides)).alias("total"),
        F.array(*(F.count_if(F.col(n) > 0) for n in sides)).alias("kinds"),
        F.map_from_entries(F.collect_list(F.struct("symbol", F.array(*sides)))).alias("counts"),
    )


@dataclass(frozen=True)
class Model:
    """``contexts``: a table that all tasks reach; None if there is nothing to compare."""

    contexts: DataFrame | None
    spark: SparkSession
    threshold: float = 0.0

    def values(self, found: DataFrame) -> DataFrame:
        """(gram, value) of different grams: log-likelihood of acceptance against rejection."""
        if self.contexts is None:
            return found.select("gram", F.lit(0).cast("decimal(20,12)").alias("value"))
        # short contexts are hot, and split by a shuffle of their own
        known = own_shuffle(self.contexts, "key")
        met = _by_order(found).join(known, "key").select(
            "gram",
            F.struct(
                "k", "total", "kinds", F.coalesce(F.col("counts")[F.col("symbol")], F.expr("array(0L, 0L)")).alias("n")
            ).alias("x"),
        )

        def likelihood(side: int) -> Column:
            def longer(p: Column, x: Column) -> Column:
                total, kinds = x["total"][side], x["kinds"][side]
                return F.when(total > 0, (x["n"][side] + kinds * p) / (total + kinds)).otherwise(p)

            return F.log(F.aggregate("met", F.lit(1 / SYMBOLS), longer))

        met = met.groupBy("gram").agg(F.sort_array(F.collect_list("x")).alias("met"))
        # decimals add up to the same sum in any order
        return met.select("gram", (likelihood(0) - likelihood(1)).cast("decimal(20,12)").alias("value"))

    def score(self, urls: pd.Series) -> np.ndarray:
        """Scores of a few URLs, for use on the driver."""
        rows = self.spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, url string")
        return add_score(rows, self, "score").orderBy("i").toPandas()["score"].to_numpy()


def bare(url: Column) -> Column:
    """What the models read: the URL without its scheme; empty for null."""
    return F.coalesce(F.regexp_replace(url, r"(?s)^.*?://", ""), F.lit(""))


def fit(labelled: DataFrame) -> Model:
    """Models and threshold from rows (url, verdict); all rows count, none is sampled.

    Contexts and counts are exact and stay in tables. Without a URL of
    either class both models say the same and nothing is blocked.
    """
    rows = labelled.select(
        "url", (F.col("verdict") == BLOCK).cast("int").alias("side")
    ).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)))
    train = rows.where("fold <> 0").withColumn("row", F.lit(0).cast("long"))
    contexts = saved(context_table(gram_table(train)), "contexts")
    # the context of no characters has the totals
    whole = contexts.where("key = 0").select("total").first()
    model = Model(contexts if whole and all(whole["total"]) else None, labelled.sparkSession)
    scored = add_score(rows.where("fold = 0").select("url", "side"), model, "score")
    step = F.floor(F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), F.col("score"))) * (_STEPS / _LIMIT))
    table = scored.groupBy("side", step.alias("step")).agg(F.count("*").alias("n")).collect()
    return replace(model, threshold=_threshold(table))


def _threshold(table: list) -> float:
    """Where accepted URLs from here on and rejected ones below, in shares, add up to most."""
    shares = np.zeros((2, 2 * _STEPS + 1))
    for r in table:
        shares[r["side"], r["step"] + _STEPS] += r["n"]
    totals = shares.sum(1)
    if not totals.all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(shares / totals[:, None], 1)], 1)
    gain = below[1] - below[0]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[len(best) // 2] - _STEPS) * _LIMIT / _STEPS)


def add_score(df: DataFrame, model: Model, name: str, url: str = "url") -> DataFrame:
    """``df`` with the log-likelihood ratio for each character on average; 0 for empty URLs."""
    row = fresh(df.columns, "row")
    # numbered once and written, so that a number always means the same row
    kept = saved(df.withColumn(row, F.monotonically_increasing_id()), "urls")
    table = saved(
        gram_table(
            kept.select(
                F.col(row).alias("row"), F.lit(None).cast("int").alias("side"), F.col(f"`{url}`").alias("url")
            )
        ),
        "grams",
    )
    values = own_shuffle(model.values(table.select("gram").distinct()), "gram")
    score = F.sum(F.col("value") * F.col("n")).cast("double") / F.sum("n")
    scores = table.join(values, "gram").groupBy(F.col("row").alias(row)).agg(score.alias(name))
    return kept.join(scores, row, "left").select(*df.columns, F.coalesce(name, F.lit(0.0)).alias(name))


def judge_urls(df: DataFrame, url: str = "url", key: str = "page_id", rules=RULES) -> DataFrame:
    """(key, host, path, rule, verdict, score) for each row of ``df``.

    The rule's verdict where one fits, else the models'. A null URL or one without
    ``://`` has an empty host and path and fits no rule; an empty one scores 0. Repeated rows
    are judged alike; an empty table gives no rows.
    """
    u = F.col(f"`{url}`")
    parts = df.select(
        F.col(f"`{key}`").alias("id"), u.alias("whole"), host_of(u).alias("host"), path_of(u).alias("path")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = parts.select(
        "id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), bare(F.col("whole")).alias("url")
    )
    model = fit(rows.where("rule is not null").select("url", F.col("ruled").alias("verdict")))
    found = add_score(rows, model, "score")
    by_model = F.when(F.col("score") < F.lit(model.threshold), BLOCK).otherwise(ALLOW)
    return found.select(
        F.col("id").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_model).alias("verdict"),
        "score",
    )
