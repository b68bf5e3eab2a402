"""Near copies: texts that share four fifths of their different five-word shingles.

At that similarity 15 % of the bits of a SimHash differ, of any width, which no small
radius reaches. Min-wise hashes find the candidates instead: two texts agree in one hash
with a probability equal to their similarity, and are compared if they agree in all hashes
of a band. All candidates are compared by their whole shingle sets, so that no link is wrong;
a pair that shares just 80 % is missed with a probability of 0.672^24, 1 in 14,000.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.llm.shared import begin_step, saved
from tallybook.operators.match import own_shuffle

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND = 24, 5
_CHUNK = 512
#: Texts are taken together up to so many characters.
TOGETHER = 1 << 22
_BLOCK = 1 << 15
_RANDOM = np.random.default_rng(42)
# products of 32 bits: processors form eight at once, of 64 bits one by one
_FLIP = _RANDOM.integers(0, 1 << 32, (BANDS * BAND, 1), np.uint32)
_FACTOR = _RANDOM.integers(0, 1 << 31, (BANDS * BAND, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _chain(values: list[np.ndarray]) -> np.ndarray:
    total = np.zeros_like(values[0])
    for v in values:
        total = _mix(total * _MULTIPLIER + v)
    return total


def together(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Runs of texts, an empty one for null, of ``TOGETHER`` characters or little more, or one longer text."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t or "") > TOGETHER:
            yield held
            held, size = [], 0
        held.append(t or "")
        size += len(held[-1])
    if held:
        yield held


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different words, the place there of each word of the texts, where the words of each text end).

    Words are separated by ASCII white space, A-Z lower-cased.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    words = split.flatten()
    # white space at either end of a text has an empty word beside it
    full = pc.binary_length(words).to_numpy() > 0
    ends = np.append(0, np.cumsum(full))[np.cumsum(pc.list_value_length(split).to_numpy())]
    coded = words.filter(pa.array(full)).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), ends


def shingle_sets(words: list[str], at: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """``shingles`` of each text whose words ``words_of`` gave."""
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[at]
    whole = np.empty(max(0, len(codes) - SHINGLE + 1), np.uint64)
    for i in range(0, len(whole), _BLOCK):
        last = min(i + _BLOCK, len(whole))
        whole[i:last] = _chain([codes[i + k : last + k] for k in range(SHINGLE)])
    out, begin = [], 0
    for end in ends.tolist():
        if end - begin >= SHINGLE:
            out.append(_different(whole[begin : end - SHINGLE + 1]))
        else:
            out.append(_chain(list(codes[begin:end, None])) if begin < end else codes[:0])
        begin = end
    return out


def _different(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    again = values[1:] == values[:-1]
    return values[np.append(True, ~again)] if again.any() else values


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the different shingles; a shorter text is one, an empty one none."""
    return shingle_sets(*words_of([text or ""]))[0]


def _least(own: np.ndarray) -> np.ndarray:
    """The min-wise hashes of a set that is not empty."""
    short = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * BAND, (1 << 32) - 1, np.uint32)
    room = np.empty((BANDS * BAND, min(_CHUNK, len(short))), np.uint32)
    for i in range(0, len(short), _CHUNK):
        part = short[None, i : i + _CHUNK]
        products = room[:, : part.shape[1]]
        np.bitwise_xor(part, _FLIP, out=products)
        np.multiply(products, _FACTOR, out=products)
        np.minimum(least, products.min(1), out=least)
    return least


def bands(sets: list[np.ndarray]) -> list[np.ndarray]:
    """A key for each band of min-wise hashes of each set; an empty set has none."""
    full = [s for s in sets if len(s)]
    least = np.array([_least(s) for s in full], np.uint64).reshape(len(full), BANDS, BAND)
    first = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), least.shape[:2])
    keys = iter(_chain([first, *np.moveaxis(least, 2, 0)]).view(np.int64))
    return [next(keys) if len(s) else np.zeros(0, np.int64) for s in sets]


def similar(shared, a, b):
    """Whether sets of sizes ``a`` and ``b`` that share so many are near copies."""
    return shared >= SIMILARITY * (a + b - shared) - 1e-9


MARKS = "shingles binary, bands array<bigint>"


def marks_of_sets(sets: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "shingles": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "bands": bands(sets),
        }
    )


def marks_of(texts: pd.Series) -> pd.DataFrame:
    parts = [marks_of_sets(shingle_sets(*words_of(some))) for some in together(texts)]
    return pd.concat(parts, ignore_index=True)


def _sets(texts: pd.Series) -> pd.Series:
    begin_step("shingles")
    return pd.Series([s.tobytes() for some in together(texts) for s in shingle_sets(*words_of(some))])


def _agree(left: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(left, right, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        out.append(bool(similar(len(np.intersect1d(x, y, True)), len(x), len(y))))
    return pd.Series(out, dtype=bool)


def forest(sets: list[np.ndarray], roots: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions that connect whatever chains of near copies connect.

    Sets with the same root are connected already and are not compared; the roots with
    the fewest sets come first.
    """
    sizes = np.array([len(s) for s in sets])
    known = np.unique(roots, return_inverse=True)[1]
    rest, links = np.ones(len(sets), bool), []
    # nothing is left to compare the last root with
    for root in np.argsort(np.bincount(known), kind="stable")[:-1]:
        queue = np.flatnonzero(rest & (known == root)).tolist()
        rest[queue] = False
        while queue and rest.any():
            x = queue.pop()
            # near copies share no more than the smaller set has, so others are too small or too large
            fit = np.flatnonzero(rest & similar(np.minimum(sizes, sizes[x]), sizes[x], sizes))
            if not len(fit):
                continue
            whole, begins = np.concatenate([sets[i] for i in fit]), np.cumsum(sizes[fit]) - sizes[fit]
            at = np.minimum(np.searchsorted(sets[x], whole), sizes[x] - 1)
            shared = np.add.reduceat((sets[x][at] == whole).astype(np.int64), begins)
            near = fit[similar(shared, sizes[x], sizes[fit])]
            links += [(x, int(i)) for i in near]
            found = np.flatnonzero(rest & np.isin(known, known[near]))
            rest[found] = False
            queue += found.tolist()
    return links


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) in buckets, of rows (band, node, root, own) that arrive sorted by band."""
    held = None
    for b in batches:
        held = b if held is None else pd.concat([held, b], ignore_index=True)
        last = held["band"].iloc[-1] if len(held) else None
        yield _links_in(held[held["band"] != last])
        held = held[held["band"] == last]
    if held is not None:
        yield _links_in(held)


def _links_in(rows: pd.DataFrame) -> pd.DataFrame:
    """The links of all buckets of sorted rows in one frame; there are many small buckets."""
    band, node, root = (rows[c].to_numpy() for c in ("band", "node", "root"))
    sets, links = [np.frombuffer(x, np.uint64) for x in rows["own"]], []
    cuts = [0, *(np.flatnonzero(band[1:] != band[:-1]) + 1).tolist(), len(rows)]
    for i, j in zip(cuts, cuts[1:]):
        if i < j:
            links += [(i + x, i + y) for x, y in forest(sets[i:j], root[i:j].tolist())]
    at = np.array(links, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": node[at[:, 0]], "b": node[at[:, 1]]})


def near_copies(rows: DataFrame) -> DataFrame:
    """(node, root) for rows (node, text), node a different long each.

    root: the least node that chains of near copies lead to, the row itself included. Empty
    texts are copies of each other. Texts of equal shingles are compared as one. The members
    of a bucket are first compared with its least; only buckets whose members are
    not all connected then are compared throughout, each by one task.
    """
    marks = F.pandas_udf(marks_of, MARKS)
    marked = saved(
        rows.select("node", marks("text").alias("m")).select("node", "m.shingles", "m.bands"),
        "signatures",
    )
    return linked(marked, rows)


def _mixed_bands(placed: DataFrame) -> DataFrame:
    """(band) of the buckets of rows (band, node, root) that hold several roots, one of those with the same nodes.

    Near copies meet in several bands. Nodes are compared by number, least, greatest and hash.
    """
    buckets = placed.groupBy("band").agg(
        F.min("root").alias("m"),
        F.max("root").alias("n"),
        F.min("node").alias("least"),
        F.max("node").alias("greatest"),
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("hash"),
    )
    same = buckets.where("m <> n").groupBy("least", "greatest", "size", "hash")
    return same.agg(F.min("band").alias("band")).select("band")


def linked(marked: DataFrame, rows: DataFrame) -> DataFrame:
    """``near_copies`` of ``rows`` whose marks (node, shingles, bands) are known; both are read several times."""
    least = saved(
        marked.groupBy("shingles")
        .agg(F.min(F.struct("node", "bands")).alias("m"))
        .select("shingles", F.col("m.node").alias("least"), F.col("m.bands").alias("bands")),
        "shingles",
    )
    buckets = least.select(F.col("least").alias("node"), F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n"))
    # buckets with one member are of no use
    shared = own_shuffle(heads.where("n > 1").drop("n"), "band")
    buckets = saved(buckets.join(shared, "band"), "buckets")
    candidates = buckets.select("node").distinct()
    sets = saved(
        rows.join(candidates, "node", "left_semi").select(
            "node", F.pandas_udf(_sets, "binary")("text").alias("own")
        ),
        "sets",
    )
    pairs = buckets.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b"))
    both = (
        pairs.distinct()
        .join(sets.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    )
    links = saved(both.where(F.pandas_udf(_agree, "boolean")("x", "y")).select("a", "b"), "links")
    roots = saved(components(links), "roots")
    placed = saved(
        buckets.select("band", "node")
        .join(roots, "node", "left")
        .select("band", "node", F.coalesce("root", "node").alias("root")),
        "placed",
    )
    mixed = placed.join(own_shuffle(_mixed_bands(placed), "band"), "band", "left_semi")
    more = saved(
        mixed.join(sets, "node")
        .select("band", "node", "root", "own")
        .repartition("band")
        .sortWithinPartitions("band")
        .mapInPandas(_bucket_links, "a long, b long"),
        "links",
    )
    # a root stands for what is connected already
    known = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    final = components(known.unionByName(more)).withColumnRenamed("node", "least")
    return (
        marked.select("node", "shingles")
        .join(least.select("shingles", "least"), "shingles")
        .join(final, "least", "left")
        .select("node", F.coalesce("root", "least").alias("root"))
    )
