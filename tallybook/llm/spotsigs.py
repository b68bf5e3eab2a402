"""Document fingerprints from spots: common words and the content words that follow them.

Each common word (anchor) of a text gives a signature, the chain of the next content words
behind it. Function words are spread over running prose, less so over menus, lists and
markup, so the signatures stand for what a text says. A fingerprint is the set of signatures,
a repeated one counted with its number; texts are compared by the Jaccard similarity of
these sets. ``near_classes`` finds similar documents among all: sets are partitioned by length,
since similar sets are of similar length, and within a partition only sets that share one of
their rarest signatures early enough are compared.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallybook.llm.components import components
from tallybook.llm.shared import ShortPieces, fresh, saved
from tallybook.operators.match import own_shuffle

#: Content words in a chain.
CHAIN = 3
#: After so many words without an anchor, one word in four stands in for anchors, by its hash:
#: other languages, lists, code.
GAP = 8
SIMILARITY = 0.8
#: The members of a bucket are compared with so many heads before what is not connected is compared pair by pair.
ROUNDS = 3
#: Members of a bucket that are joined with the rest of it in one go.
BLOCK = 4096
# Frequent function words.
ANCHORS = frozenset(
    (
        "a an and are as at be but by for from had has have he in is it of on or that the this to was were which with "
        "au aux ce dans des du elle est et il la le les mais ne ou par pas plus pour que qui se sur un une "
        "al como con del el en es esta la las lo los más no para pero por se su sus una y "
        "als auch auf aus bei das dem den der die ein eine für im ist mit nicht sich sie sind und von wie zu "
        "的 了 是 在 の に は を"
    ).split()
)
_ALONE = "぀-ヿ㐀-䶿一-鿿豈-﫿"
#: Words; ideographs and kana, which no space separates, are words of one character.
_WORD = re.compile(f"[{_ALONE}]|[^\\W{_ALONE}]+")
_ONE, _FACTOR = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)
_START = 0x5350_4F54
#: The last bit of a word's number tells anchors from content words.
_numbers = ShortPieces(lambda w: xxhash.xxh3_64_intdigest(w) & ~1 | (w in ANCHORS))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FACTOR
    return x ^ (x >> np.uint64(29))


def spots(text: str | None) -> np.ndarray:
    """Sorted numbers of the signatures of a text; the k-th of equal signatures is one of its own.

    The start of a text counts as an anchor, so that short texts have a signature too; chains at
    the end may be shorter. A text without any chain has one signature, the whole text;
    null and empty texts have none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    words = _WORD.findall(text.lower())
    codes = np.fromiter(map(_numbers.__getitem__, words), np.uint64, len(words))
    listed = (codes & _ONE).astype(bool)
    content = np.append(codes[~listed], np.zeros(CHAIN, np.uint64))
    if len(content) == CHAIN:
        return np.array([xxhash.xxh3_64_intdigest(text, 1)], np.uint64)
    at = np.arange(len(codes))
    gap = at - np.maximum.accumulate(np.where(listed, at, 0)) > GAP
    anchors = listed | (gap & (codes >> np.uint64(8) & np.uint64(3) == 0))
    # the content word that follows each anchor, as a position among content words
    follows = np.append(0, np.cumsum(~listed)[anchors])
    found = np.append(np.uint64(_START), codes[anchors])
    found, follows = found[follows < len(content) - CHAIN], follows[follows < len(content) - CHAIN]
    for k in range(CHAIN):
        found = _mix(found * _FACTOR + content[follows + k])
    found, counts = np.unique(found, return_counts=True)
    if len(found) == counts.sum():
        return found
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    again = _mix(np.repeat(found, counts) + nth.astype(np.uint64) * _FACTOR)
    return np.unique(np.where(nth == 0, np.repeat(found, counts), again))


def digest(own: np.ndarray) -> str:
    """A fingerprint as 32 hex digits."""
    return xxhash.xxh3_128_hexdigest(own.tobytes())


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two fingerprints; two empty ones are alike.

    Below ``least`` it is 0, without a comparison where the lengths alone decide.
    """
    shorter, longer = sorted((len(a), len(b)))
    if not shorter or shorter < least * longer - 1e-9:
        return float(shorter == longer)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    found = shared / (shorter + longer - shared)
    return found if found >= least - 1e-9 else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_REPORT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _report(text: str, own: np.ndarray, following: str, of_next: np.ndarray) -> tuple:
    changed = edited(text, following)
    of_changed = spots(changed)
    return (
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        digest(own),
        digest(of_changed),
        likeness(own, of_changed),
        likeness(own, of_next),
    )


def _along(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Reports on rows (key, text) in order, each compared with the one after it.

    The first row of a task comes back as its head as well, the last one only as its
    tail, both with their texts: what follows it is in another task.
    """
    part, last = TaskContext.get().partitionId(), None

    def table(keys: pa.Array, kind: str, rows: list[tuple], texts: list | None) -> pa.RecordBatch:
        n = len(keys)
        columns = list(zip(*rows)) if rows else [[None] * n] * 6
        kinds = ("long", "string", "string", "string", "double", "double")
        arrays = [pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds)]
        texts = pa.array(texts if texts else [None] * n, pa.string())
        fixed = [pa.array([part] * n, pa.int32()), pa.array([kind] * n)]
        return pa.RecordBatch.from_arrays([*fixed, keys, *arrays, texts], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, rows = [], []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py()
            own = spots(text)
            if last is None:
                yield table(batch.column(0).slice(0, 1), "head", [], [text])
            else:
                keys.append(last[0])
                rows.append(_report(last[1], last[2], text, own))
            last = batch.column(0).slice(i, 1), text, own
        if rows:
            yield table(pa.concat_arrays(keys), "row", rows, None)
    if last is not None:
        yield table(last[0], "tail", [], [last[1]])


_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def spot_report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) a row.

    Rows follow each other by falling key, null keys last, rows of equal keys by a hash of
    their texts and then as stored; the first row follows the last. The edited text of a row has
    its last third replaced by the start of the next row's text. A null text is empty; two
    empty texts are alike (1). A single row is its own next; an empty table gives no rows.

    The texts are shuffled once, into ranges of keys. Each task reports on all its rows but the
    last; the last ones, one a task, are joined with the first ones of the tasks after them.
    """
    stored = fresh([key, text], "stored")
    rows = df.select(F.col(f"`{key}`"), F.col(f"`{text}`"), F.monotonically_increasing_id().alias(stored))
    rows = rows.withColumn(text, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    order = [F.desc_nulls_last(f"`{key}`"), F.xxhash64(F.col(f"`{text}`")).asc(), F.asc(stored)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType(
        StructType.fromDDL("part int, kind string").fields
        + [StructField("key", df.schema[key].dataType)]
        + StructType.fromDDL(f"{_REPORT}, text string").fields
    )
    done = ordered.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(
        lambda batches: _along(batches, schema.names), schema
    )
    done = saved(done, "spots")
    heads = done.where("kind = 'head'").select("part", F.col("text").alias("following"))
    # one row a task
    along = Window.orderBy("part")
    first = F.first("part").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = heads.select("part", F.coalesce(F.lead("part").over(along), first).alias("next"))
    tails = (
        done.where("kind = 'tail'")
        .select("part", "key", "text")
        .join(parts, "part")
        .join(heads.withColumnRenamed("part", "next"), "next")
    )

    def finish(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        pairs = [_report(a, spots(a), b, spots(b)) for a, b in zip(texts, following)]
        return pd.DataFrame(pairs, columns=names)

    names = StructType.fromDDL(_REPORT).names
    report = F.pandas_udf(finish, _REPORT)("text", "following").alias("r")
    rest = tails.select("key", report).select("key", "r.*")
    return (
        done.where("kind = 'row'")
        .select("key", *names)
        .unionByName(rest)
        .withColumnRenamed("key", key)
    )


def _pruned(a: str, b: str, similarity: float):
    """Whether rows (n, pos) may be similar if no signature before ``pos`` is shared.

    By the lengths alone, and by what is left of both sets from the shared signature on.
    """
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    lengths = F.least(f"{a}.n", f"{b}.n") >= F.greatest(f"{a}.n", f"{b}.n") * similarity - 1e-6
    return lengths & (left >= n * (similarity / (1 + similarity)) - 1e-6)


def _buckets(sets: DataFrame, similarity: float) -> DataFrame:
    """(part, spot, node, n, pos): the rarest signatures of each of the ``sets`` (node, n, own).

    Two similar sets share one of them, as any order of the signatures would have it;
    rarest first keeps buckets small. A signature that only one set has makes no bucket, but
    counts in the positions of the others. A set is in the bucket of its own length
    partition and in the one below.
    """
    spread = sets.select("node", "n", F.explode("own").alias("spot"))
    counts = spread.groupBy("spot").agg(F.count("*").alias("sets")).where("sets > 1")
    held = (
        spread.join(own_shuffle(counts, "spot"), "spot")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("sets", "spot"))).alias("held"))
    )
    ratio = -np.log(similarity) + 1e-9
    part = F.floor(F.log(F.col("n").cast("double")) / ratio)
    prefix = F.col("n") - F.ceil(F.col("n") * similarity - 1e-6) + 1
    return (
        held.select("node", "n", F.posexplode("held").alias("at", "h"), F.size("held").alias("m"))
        .withColumn("pos", F.col("n") - F.col("m") + F.col("at"))
        .where(F.col("pos") < prefix)
        .select(F.explode(F.array(part, part - 1)).alias("part"), F.col("h.spot").alias("spot"), "node", "n", "pos")
    )


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the different ``pairs`` (a, b) whose whole sets are similar."""

    def udf(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(a, b, similarity) > 0 for a, b in zip(x, y)], dtype=bool)

    sides = [sets.select(F.col("node").alias(c), F.col("own").alias(v)) for c, v in ("ax", "by")]
    both = pairs.distinct().join(own_shuffle(sides[0], "a"), "a").join(own_shuffle(sides[1], "b"), "b")
    return saved(both.where(F.pandas_udf(udf, "boolean")("x", "y")).select("a", "b"), "links")


def near_classes(
    df: DataFrame, similarity: float = SIMILARITY, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, class_id) for each row of ``df``: the least key that chains of similar texts lead to.

    Texts are similar if their fingerprints are, by ``likeness``; the search is exact. Null and
    empty texts are alike and in one class. A row without a key gets its class's least key, null
    if there is none; repeated rows come back as often as they are there; an empty table gives
    no rows.

    Equal fingerprints count once. The members of a bucket are compared with one head, then what
    is not connected yet with other heads, so that a group of many copies costs a row for each.
    Only members of different classes that are left are compared pair by pair, in blocks.
    """
    mark = F.pandas_udf(lambda s: pd.Series([spots(t).view(np.int64) for t in s]), "array<bigint>")
    rows = saved(
        df.select(
            F.col(f"`{key}`").alias("id"),
            F.monotonically_increasing_id().alias("node"),
            mark(F.col(f"`{text}`")).alias("own"),
        ).withColumn("print", F.sha2(F.concat_ws(",", F.col("own").cast("array<string>")), 256)),
        "spots",
    )
    least = saved(rows.groupBy("print").agg(F.min("node").alias("node")), "distinct")
    sets = rows.join(least.select("node"), "node", "left_semi").where(F.size("own") > 0)
    sets = saved(sets.select("node", F.size("own").cast("long").alias("n"), "own"), "sets")
    buckets = _buckets(sets, similarity)
    shared = buckets.groupBy("part", "spot").agg(F.count("*").alias("members")).where("members > 1")
    buckets = saved(buckets.join(own_shuffle(shared, "spot"), ["part", "spot"]), "buckets")
    links = sets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    roots = sets.select("node", F.col("node").alias("root")).limit(0)
    for turn in range(ROUNDS + 1):
        placed = buckets.join(own_shuffle(roots, "node"), "node", "left")
        placed = placed.withColumn("root", F.coalesce("root", "node"))
        chosen = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("by"), "node", "n", "pos", "root"))
        heads = placed.groupBy("part", "spot").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), chosen.alias("head")
        )
        heads = heads.where("low < high").select("part", "spot", "head.*")
        placed = saved(placed.join(own_shuffle(heads.select("part", "spot"), "spot"), ["part", "spot"], "left_semi"), "placed")
        if placed.isEmpty():
            break
        if turn < ROUNDS:
            x, y = own_shuffle(heads, "spot").alias("x"), placed.alias("y")
            same = F.expr("x.part = y.part AND x.spot = y.spot AND x.root <> y.root")
        else:
            blocks = F.ceil(F.col("members") / BLOCK).cast("int")
            x = placed.withColumn("block", F.pmod(F.hash("node"), blocks)).alias("x")
            y = placed.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).alias("y")
            same = F.expr("x.part = y.part AND x.spot = y.spot AND x.block = y.block AND x.root < y.root")
        pairs = x.join(y, same & _pruned("x", "y", similarity)).select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        )
        found = _alike(pairs, sets, similarity)
        if found.isEmpty():
            continue
        links = links.unionByName(found)
        roots = saved(components(links), "roots")
    final = least.join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("root"))
    named = rows.select("id", "print").join(own_shuffle(final, "print"), "print")
    lowest = named.groupBy("root").agg(F.min("id").alias("class_id"))
    return named.join(own_shuffle(lowest, "root"), "root").select(F.col("id").alias(key), "class_id")
