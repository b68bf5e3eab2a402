"""The language of a text, by its nearest centroid.

A text becomes a vector of TF-IDF weights of its hashed byte n-grams, of length one.
Each language has several centroids, found by clustering its sample, so that a language
need not look the same everywhere. The language of the centroid with the largest
cosine wins; a text that is further from every centroid than almost all texts of its
length are is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import begin_step, fresh

#: Bound of the sample for the fit: texts per language.
SAMPLE = 800
CENTROIDS = 4
DIMENSIONS = 4096
#: Share of the sample that lies below the rejection threshold of its length class, and
#: how far below that share's cosine the threshold is set.
REJECT_SHARE = 0.005
REJECT_SLACK = 0.8
UNKNOWN = "und"
_PIECE = 1 << 20
_COMMON_LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]")
#: ASCII letters (lower-cased) and bytes beyond ASCII stay; all else separates words.
_LETTERS = np.array(
    [b | 32 if chr(b).isalpha() and b < 128 else b if b > 127 else 32 for b in range(256)], np.uint32
)


def has_letter(text: str | None) -> bool:
    return bool(text) and (
        _COMMON_LETTER.search(text) is not None or any(c.isalpha() for c in set(text))
    )


def ngram_counts(text: str, size: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed 2-, 3- and 4-grams of the whole text's UTF-8 bytes.

    Long texts are taken in pieces that overlap, so that memory stays bounded and no
    n-gram is lost or counted twice.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(size, np.float32)
    for i in range(0, max(len(data), 1), _PIECE):
        b = _LETTERS[data[max(0, i - 3) : i + _PIECE]]
        first = 3 if i else 0
        if not i:
            b = np.concatenate([np.array([32], np.uint32), b])
        if i + _PIECE >= len(data):
            b = np.append(b, np.uint32(32))
        gram = b.copy()
        for n in (2, 3, 4):
            if len(b) < n:
                break
            gram = gram[:-1] * np.uint32(0x01000193) ^ b[n - 1 :]
            # those that end in the part before are counted already
            new = gram[max(0, first - n + 1) :]
            new = new[(b[max(0, first - n + 1) : len(b) - n + 1] != 32) | (n < 4)]
            slot = (new * np.uint32(0x9E3779B1)) >> np.uint32(32 - (size.bit_length() - 1))
            counts += np.bincount(slot, minlength=size).astype(np.float32)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of TF-IDF weights of length one; rows of zeros stay."""
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def length_class(counts: np.ndarray) -> np.ndarray:
    """Classes of n-gram totals that double from one to the next."""
    return np.minimum(24, np.log2(counts.sum(-1) + 1).astype(int))


@dataclass(frozen=True)
class Model:
    """Everything a prediction needs; at most a few hundred kilobytes."""

    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        """lang, score (cosine, 0 to 1) and rejected for each text."""
        lang, score, rejected = [], [], []
        for text in texts:
            if not self.languages or not has_letter(text):
                found = (UNKNOWN, 0.0, True)
            else:
                counts = ngram_counts(text, len(self.idf))
                cosine = self.centroids @ weigh(counts, self.idf)
                best = int(cosine.argmax())
                near = float(min(1.0, max(0.0, cosine[best])))
                found = (
                    self.languages[self.owner[best]],
                    near,
                    near < self.least[length_class(counts)],
                )
            lang.append(found[0])
            score.append(found[1])
            rejected.append(bool(found[2]))
        return pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})


def clusters(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Up to ``k`` centroids of length one, by k-means on the unit sphere."""
    rng = np.random.default_rng(seed)
    centre = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centre.T).argmax(1)
        sums = np.stack(
            [
                rows[nearest == i].sum(0) if (nearest == i).any() else centre[i]
                for i in range(len(centre))
            ]
        )
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centre.astype(np.float32)


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    centroids: int = CENTROIDS,
) -> Model:
    """Centroids from a sample of about ``sample`` texts of each language.

    The sample is drawn by a hash of the text; rows without a language or a letter are
    left out. Only its vectors come to the driver, 8 KB each. Languages are taken to be
    some dozens.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        "lang is not null and text is not null"
    )
    # the number of different texts of a language sets the share of hashes that is drawn
    different = F.approx_count_distinct(F.xxhash64("text")).alias("n")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(different).collect()}
    if not sizes:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Model([], none, np.zeros(0, int), np.ones(DIMENSIONS, np.float32), np.zeros(25))
    parts = 1 << 20
    limit = F.create_map(
        *(F.lit(x) for k, n in sizes.items() for x in (k, max(1, parts * sample // max(1, n))))
    )
    # copies of a text are drawn together, so they are reduced to one
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(parts)) < limit[F.col("lang")]).distinct()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[[has_letter(t) for t in b["text"]]]
            counts = [
                np.minimum(ngram_counts(t), 65504).astype(np.float16).tobytes() for t in b["text"]
            ]
            yield pd.DataFrame({"lang": b["lang"].to_numpy(), "counts": counts})

    found = drawn.mapInPandas(vectors, "lang string, counts binary").toPandas()
    found = found.sort_values(["lang", "counts"], kind="stable")
    counts = np.stack(
        [np.frombuffer(c, np.float16).astype(np.float32) for c in found["counts"]]
        or [np.zeros(DIMENSIONS, np.float32)]
    )
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 0.1).astype(np.float32)
    unit = weigh(counts, idf)
    names = found["lang"].to_numpy()
    languages = sorted(set(names))
    centre = [clusters(unit[names == x], centroids) for x in languages]
    owner = np.repeat(np.arange(len(centre)), [len(c) for c in centre])
    all_centres = np.concatenate([*centre, np.zeros((0, DIMENSIONS), np.float32)])
    return Model(languages, all_centres, owner, idf, _least(unit, counts, all_centres))


def _least(unit: np.ndarray, counts: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The rejection threshold of each length class; 0 for classes below any sampled one."""
    least = np.zeros(25)
    if not len(centre):
        return least
    best, kind = (unit @ centre.T).max(1), length_class(counts)
    for k in range(25):
        # a class takes in the shorter texts, which lie further away
        own = best[(kind <= k) & (kind >= k - 2)]
        if len(own) >= 20:
            least[k] = REJECT_SLACK * np.quantile(own, REJECT_SHARE)
        elif k:
            # a longer text of a language lies nearer to it
            least[k] = least[k - 1]
    return least


def add_language(df: DataFrame, model: Model, text: str, name: str) -> DataFrame:
    """``df`` with a struct ``name`` (lang, score, rejected) from the whole text."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def udf(texts: pd.Series) -> pd.DataFrame:
        begin_step("language")
        return sent.value.predict(texts)

    kind = "lang string, score double, rejected boolean"
    return df.withColumn(name, F.pandas_udf(udf, kind)(F.col(f"`{text}`")))


def held_out(key: str):
    """Rows kept out of the fit: crc32 of the key as text is divisible by 5; null keys are not."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 5 == 0, F.lit(False))


def language_report(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) for each row of ``df``.

    Learns from rows that are not held out. ``und`` with score 0 for null texts, texts
    without a letter, and all texts if there is nothing to learn from; these are
    rejected. Repeated rows are judged alike; an empty table gives no rows.
    """
    rows = df.select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").alias("lang"),
        held_out(key).alias("held_out"),
    )
    model = fit(rows.where(~F.col("held_out")))
    found = add_language(rows.select("id", "held_out", "text"), model, "text", "found")
    return found.select(
        F.col("id").alias(key),
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


def keep_known_languages(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> DataFrame:
    """The rows of ``df`` whose text is not rejected, with the columns of ``df``."""
    name = fresh(df.columns, "found")
    model = fit(df.where(~held_out(key)), text, lang)
    found = add_language(df, model, text, name)
    return found.where(~F.col(name)["rejected"]).select(*(f"`{c}`" for c in df.columns))
