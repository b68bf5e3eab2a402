"""Near duplicates by 64-bit fingerprints and covering locality-sensitive hashing.

A family of structured bit masks makes every pair of fingerprints within the radius
agree on all bits of at least one mask. Each bit position has a label of
``radius + 1`` bits; mask v keeps the positions whose label has an odd product with v.
The labels of ``radius`` differing positions leave a v that is orthogonal to all of
them, and mask v ignores these positions: the pair falls into the same bucket of table v.
So no pair is missed and no threshold on the number of tables has to be tuned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.llm.near_copies import near_copies
from tallybook.llm.shared import begin_step, fresh, saved
from tallybook.operators.match import own_shuffle

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a bucket that are compared in one go; fuller buckets are split by
#: the masks of a second family over the bits that the first left out.
BUCKET = 4096
_CHUNK = 1 << 16


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions ``bits``: any ``radius`` of them are ignored by some mask."""
    labels = {b: 1 + i % ((1 << radius + 1) - 1) for i, b in enumerate(bits)}
    return [
        sum(1 << b for b, label in labels.items() if (label & v).bit_count() & 1)
        for v in range(1, 1 << radius + 1)
    ]


MASKS = covering_masks(list(range(64)))
#: For each mask, masks over the bits that it ignores, joined with it.
INNER = [
    [m | s for s in covering_masks([b for b in range(64) if not m >> b & 1])] for m in MASKS
]


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text; 0 without words.

    Words are separated by ASCII white space, A-Z lower-cased; a bit is set if it is
    set in over half of the hashes of the shingles, repeats included.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n, ones = max(1, len(words) - SHINGLE + 1), np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        part = words[i : min(n, i + _CHUNK) + SHINGLE - 1]
        rows = zip(*(part[k:] for k in range(SHINGLE))) if len(words) >= SHINGLE else [part]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in rows]
        packed = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(packed, axis=1), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``df`` with a column ``name``: the fingerprint's bits as a long."""

    def udf(texts: pd.Series) -> pd.Series:
        begin_step("simhash")
        found = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return df.withColumn(name, F.pandas_udf(udf, "long")(F.col(f"`{text}`")))


def bucket_links(
    batches: Iterator[pa.RecordBatch], limit: int | None
) -> Iterator[pa.RecordBatch]:
    """Links within buckets, of rows (t, k, fp) that arrive sorted by bucket.

    Gives rows (t, a, b): links a, b that connect what lies within the radius in a
    bucket, without repeating what other links say; t is null. The fingerprints of a
    bucket with over ``limit`` members come back as (t, fp, null) instead. Only one
    bucket of at most ``limit`` rows is held at a time.
    """
    names = ("t", "k", "fp")
    held = {n: np.zeros(0, np.int64) for n in names}
    passing: tuple[int, int] | None = None
    for batch in batches:
        new = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
        rows = {n: np.concatenate([held[n], new[n].astype(np.int64)]) for n in names}
        if passing is not None:
            same = (rows["t"] == passing[0]) & (rows["k"] == passing[1])
            n = len(same) if same.all() else int(np.argmin(same))
            if n:
                yield _table(rows["t"][:n], rows["fp"][:n], None)
            rows = {c: v[n:] for c, v in rows.items()}
            if not len(rows["t"]):
                held = rows
                continue
            passing = None
        if not len(rows["t"]):
            continue
        starts = _starts(rows["t"], rows["k"])
        last = int(starts[-1])
        if last:
            yield from _within({c: v[:last] for c, v in rows.items()}, starts[:-1], limit)
        held = {c: v[last:] for c, v in rows.items()}
        if limit is not None and len(held["t"]) > limit:
            passing = int(held["t"][0]), int(held["k"][0])
            yield _table(held["t"], held["fp"], None)
            held = {n: np.zeros(0, np.int64) for n in names}
    if len(held["t"]):
        yield from _within(held, np.zeros(1, np.int64), limit)


def _starts(t: np.ndarray, k: np.ndarray) -> np.ndarray:
    change = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
    return np.concatenate([[0], change])


def _within(rows: dict, starts: np.ndarray, limit: int | None) -> Iterator[pa.RecordBatch]:
    fp, t = rows["fp"].view(np.uint64), rows["t"]
    sizes = np.diff(np.append(starts, len(fp)))
    group = np.repeat(np.arange(len(starts)), sizes)
    # small buckets: row i against row i + s, for all buckets at once
    small = (sizes > 1) & (sizes <= 8)
    of_small = np.flatnonzero(small[group])
    a, b = [], []
    for s in range(1, int(sizes[small].max(initial=1))):
        i = of_small[of_small + s < len(fp)]
        i = i[group[i] == group[i + s]]
        i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= RADIUS]
        a.append(fp[i])
        b.append(fp[i + s])
    if a:
        yield _table(None, np.concatenate(a), np.concatenate(b))
    for g in np.flatnonzero(sizes > 8):
        at = slice(starts[g], starts[g] + sizes[g])
        if limit is not None and sizes[g] > limit:
            yield _table(t[at], rows["fp"][at], None)
        else:
            yield _table(None, *_forest(fp[at]))


def _forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the radius, one less than members of each part."""
    rest, a, b = fp, [], []
    queue: list[np.uint64] = []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        near = np.bitwise_count(rest ^ x) <= RADIUS
        found = rest[near]
        if len(found):
            rest = rest[~near]
            a.append(np.full(len(found), x, np.uint64))
            b.append(found)
            queue.extend(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _table(t: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    def column(v, kind):
        return pa.nulls(len(a), kind) if v is None else pa.array(v.astype(np.int64)).cast(kind)

    signed = lambda v: None if v is None else v.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [column(t, pa.int32()), column(signed(a), pa.int64()), column(signed(b), pa.int64())],
        ["t", "a", "b"],
    )


def fingerprint_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fps`` (fp) within the radius.

    Two fingerprints are connected by links exactly if steps of at most ``RADIUS``
    differing bits lead from one to the other. A bucket with more than ``bucket``
    fingerprints is split by the second family of masks. That is exact by the same
    argument, and a bucket of that level leaves at most 16 of 64 bits open, so it
    holds at most 2^16 fingerprints however large the corpus is.
    """
    schema = "t int, a long, b long"
    keyed = _keyed(fps, [(i, m) for i, m in enumerate(MASKS)])
    first = saved(keyed.mapInArrow(lambda it: bucket_links(it, bucket), schema), "links")
    links = first.where("t is null").select("a", "b")
    full = first.where("t is not null").select("t", F.col("a").alias("fp"))
    if full.isEmpty():
        return links
    inner = [(i * len(MASKS) + j, m) for i, row in enumerate(INNER) for j, m in enumerate(row)]
    second = _keyed(full, inner, per=len(MASKS)).mapInArrow(
        lambda it: bucket_links(it, None), schema
    )
    return links.unionByName(saved(second.select("a", "b"), "links"))


def _keyed(fps: DataFrame, masks: list[tuple[int, int]], per: int | None = None) -> DataFrame:
    """Each fingerprint with the key of each of its tables, sorted by bucket."""
    signed = [(i, m - (1 << 64) if m >> 63 else m) for i, m in masks]
    if per is None:
        tables = F.array(*(_key(i, m) for i, m in signed))
    else:
        tables = F.array(
            *(
                F.array(*(_key(i, m) for i, m in signed[k : k + per]))
                for k in range(0, len(signed), per)
            )
        )[F.col("t")]
    return (
        fps.select("fp", F.explode(tables).alias("x"))
        .select(F.col("x.t").alias("t"), F.col("x.k").alias("k"), "fp")
        .repartition("t", "k")
        .sortWithinPartitions("t", "k")
    )


def _key(table: int, mask: int):
    return F.struct(
        F.lit(table).alias("t"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("k")
    )


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", bucket: int = BUCKET
) -> DataFrame:
    """(key, fingerprint, component_id) for each row of ``df``.

    fingerprint: 16 lower-case hex digits. component_id: the least key among the rows
    that links reach, the row itself included. Null and empty texts have fingerprint
    zero and are linked like any other; a row without a key gets the least key of its
    component, null if there is none; repeated rows come back as often as they are
    there; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return components_of(saved(fingerprints(rows).select("id", "fp"), "fingerprints"), bucket).select(
        F.col("id").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def components_of(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``rows`` (id, fp) with component: the least id of all rows that links reach."""
    least = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(fingerprint_links(least.select("fp"), bucket)).withColumnRenamed("node", "fp")
    # fingerprints without a link are their own root
    placed = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(placed.join(lowest, "root").select("fp", "component"), "fp")


def keep_first_of_groups(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with one row of each group that links of fingerprints connect: that with the least key.

    Fingerprints, radius and shingle length are those of ``near_duplicates``. Null and empty texts are
    one group. Rows without a key stay only if their whole group has none; of several rows with the
    least key, the first stored stays. An empty table stays empty; columns may have any names.
    """
    order, fp = fresh(df.columns, "order"), fresh(df.columns, "fp")
    # numbered once and written, so that a number always means the same row
    kept = saved(fingerprints(df, text, fp).withColumn(order, F.monotonically_increasing_id()), "numbered")
    ids = kept.select(
        F.col(fp).alias("fp"),
        F.struct(
            F.col(f"`{key}`").isNull().alias("none"),
            F.col(f"`{key}`").alias("key"),
            F.col(order).alias("order"),
        ).alias("id"),
    )
    first = components_of(ids).select(F.col("component.order").alias(order)).distinct()
    first = own_shuffle(first, order)
    return kept.join(first, order, "left_semi").select(*(f"`{c}`" for c in df.columns))


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with one row of each component of ``near_copies``: that with the least key.

    Rows without a key stay only if their whole component has none. Of several rows
    with the least key, one stays.
    """
    order = fresh(df.columns, "order")
    # numbered once and written, so that a number always means the same row
    kept = saved(df.withColumn(order, F.monotonically_increasing_id()), "numbered")
    found = near_copies(kept.select(F.col(order).alias("node"), F.col(f"`{text}`").alias("text")))
    ids = kept.select(
        F.col(order).alias("node"),
        F.struct(
            F.col(f"`{key}`").isNull().alias("none"),
            F.col(f"`{key}`").alias("key"),
            F.col(order).alias("order"),
        ).alias("id"),
    )
    first = ids.join(found, "node").groupBy("root").agg(F.min("id").alias("id"))
    first = first.select(F.col("id.order").alias(order))
    return kept.join(first, order, "left_semi").select(*(f"`{c}`" for c in df.columns))
