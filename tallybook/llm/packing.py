"""Packing of texts into training sequences, best fit first, under conflicts.

A sequence takes at most one text of a source and at most one of a cluster of
duplicates. Open bins are kept in the order of their free space; each carries a bitmap
of its sources and one of its clusters. A text goes to the tightest bin that has room
and no conflict: the search starts at the least sufficient space and goes on to the next
larger one until the bitmaps agree, and only then opens a new bin.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.near_copies import MARKS, linked, marks_of_sets, shingle_sets, together, words_of
from tallybook.llm.shared import WORD_SPACE, begin_step, release, saved
from tallybook.llm.tokenizing import encoder

#: Length of a training sequence in tokens.
CAPACITY = 2048
#: The tokenizer of the token files.
TOKENIZER = "word_bpe_49k.json"
#: Texts are dealt to groups of about this many, each packed by one task, so that no task
#: grows with the corpus. The last bins of a group may stay emptier than need be.
GROUP = 20_000


class OpenBins:
    """Bins by free space. Bins of the same space and bitmap of sources are kept together."""

    def __init__(self, capacity: int) -> None:
        # space -> sources -> bins as (number, clusters)
        self._by_space: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(capacity + 1)]
        self._used = 0  # bit s is set if a bin has space s

    def take(self, length: int, source: int, cluster: int) -> tuple[int, int, int, int] | None:
        """The tightest bin (number, space, sources, clusters) for the text; it is taken out."""
        rest = self._used >> length
        space = length
        while rest:
            step = (rest & -rest).bit_length() - 1
            space += step
            for sources, bins in self._by_space[space].items():
                if sources & source:
                    continue
                for i in range(len(bins) - 1, -1, -1):
                    number, clusters = bins[i]
                    if not clusters & cluster:
                        del bins[i]
                        if not bins:
                            del self._by_space[space][sources]
                            if not self._by_space[space]:
                                self._used &= ~(1 << space)
                        return number, space, sources, clusters
            rest >>= step + 1
            space += 1
        return None

    def put(self, number: int, space: int, sources: int, clusters: int) -> None:
        """Also for a new bin; one without space is full and not kept."""
        if space:
            self._by_space[space].setdefault(sources, []).append((number, clusters))
            self._used |= 1 << space


def pack(
    lengths: Iterable[int], sources: Iterable[int], clusters: Iterable[int], capacity: int
) -> list[tuple[int, int]]:
    """(bin, offset) for each piece, in the order given; longest first packs best.

    ``sources`` and ``clusters`` are small numbers, -1 for none; bit n of a bitmap stands
    for number n, so that bitmaps are exact.
    """
    bins, placed, opened = OpenBins(capacity), [], 0
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        own = 1 << source if source >= 0 else 0
        kind = 1 << cluster if cluster >= 0 else 0
        found = bins.take(length, own, kind)
        if found is None:
            found = opened, capacity, 0, 0
            opened += 1
        number, space, in_it, kinds = found
        placed.append((number, capacity - space))
        bins.put(number, space - length, in_it | own, kinds | kind)
    return placed


def _codes(values: pd.Series) -> np.ndarray:
    """Small numbers for values that occur more than once, -1 for null.

    A value that occurs once conflicts with nothing, so it needs no bit.
    """
    codes = pd.factorize(values)[0]
    often = np.bincount(codes[codes >= 0], minlength=1) > 1
    known = codes >= 0
    codes[known & ~often[np.maximum(codes, 0)]] = -1
    return pd.factorize(pd.Series(codes).where(codes >= 0))[0]


def pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins for one group of rows (id, size, source, cluster, row, part)."""
    rows = rows.sort_values(["size", "row"], ascending=[False, True])
    size = rows["size"].to_numpy()
    pieces = np.maximum(1, -(-size // capacity))
    at = np.repeat(np.arange(len(rows)), pieces)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.minimum(capacity, size[at] - piece * capacity)
    source, cluster = _codes(rows["source"])[at], _codes(rows["cluster"])[at]
    order = np.argsort(-length, kind="stable")
    placed = pack(
        length[order].tolist(), source[order].tolist(), cluster[order].tolist(), capacity
    )
    return pd.DataFrame(
        {
            "id": rows["id"].to_numpy()[at[order]],
            "piece": piece[order],
            "part": rows["part"].iloc[0] if len(rows) else 0,
            "bin": [b for b, _ in placed],
            "start": [s for _, s in placed],
            "length": length[order],
        }
    )


def pack_rows(
    rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """(id, piece, bin_id, start, length) for rows (id, size, source, cluster).

    A text longer than ``capacity`` is cut into pieces of ``capacity`` and a rest. Rows
    are numbered, written without their texts, and dealt evenly by a hash of the number, a
    hot source or cluster like any other: it meets itself only inside a group, where its
    texts go to different bins. A null source or
    cluster conflicts with nothing; a size below 1 counts as 1. A column ``row`` of different
    numbers is taken as it is.
    """
    number = F.col("row") if "row" in rows.columns else F.monotonically_increasing_id()
    rows = saved(
        rows.select(
            F.col("id"),
            F.greatest(F.coalesce("size", F.lit(1)), F.lit(1)).cast("long").alias("size"),
            F.col("source").cast("string").alias("source"),
            F.col("cluster").cast("long").alias("cluster"),
            number.alias("row"),
        ),
        "lengths",
    )
    parts = max(1, -(-rows.count() // group))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    packed = dealt.groupBy("part").applyInPandas(
        lambda pdf: pack_group(pdf, capacity),
        "id long, piece int, part long, bin long, start int, length int",
    )
    return packed.select(
        "id",
        "piece",
        (F.col("part") * (1 << 32) + F.col("bin")).alias("bin_id"),
        "start",
        "length",
    )


def has_words(text: str = "text"):
    return F.trim(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD_SPACE)) != ""


def pack_texts(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    capacity: int = CAPACITY,
    group: int = GROUP,
    tokenizer: str | None = None,
) -> DataFrame:
    """(key, piece, bin_id, start, length): where each text of ``df`` goes.

    Lengths are in tokens of the file ``tokenizer``, that of the token files by default, one more
    for the end id. A cluster is a component of
    ``near_copies``; texts without words have none. Every row is placed, null and empty
    texts with length 1, repeated rows each for itself; an empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def marks(texts: pd.Series) -> pd.DataFrame:
        begin_step("packing", encoder.cache_clear)
        counts, parts = encoder(path).counts, []
        for some in together(texts):
            words = words_of(some)
            parts.append(marks_of_sets(shingle_sets(*words)).assign(size=counts(some, *words) + 1))
        del words
        release()
        return pd.concat(parts, ignore_index=True)

    # numbered and written in one pass over the texts, so that a number always means the same row;
    # what follows reads numbers only, and the texts of candidates
    marked = saved(
        df.select(
            F.col(f"`{key}`").alias("id"),
            F.col(f"`{text}`").alias("text"),
            F.col(f"`{source}`").alias("source"),
            F.monotonically_increasing_id().alias("node"),
        )
        .select(
            "id",
            "text",
            "source",
            "node",
            has_words("text").alias("words"),
            F.pandas_udf(marks, f"{MARKS}, size long")("text").alias("m"),
        )
        .select("id", "text", "source", "node", "words", "m.*"),
        "marks",
    )
    roots = linked(marked.select("node", "shingles", "bands"), marked.select("node", "text"))
    rows = marked.join(roots, "node").select(
        "id", "source", F.col("node").alias("row"), "size", F.when(F.col("words"), F.col("root")).alias("cluster")
    )
    return pack_rows(rows, capacity, group).withColumnRenamed("id", key)
