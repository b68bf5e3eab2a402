"""Whitening of embeddings: leading principal components at unit variance.

Vectors are whole numbers, ``floor(scale * entry)``, so that sums and distances are exact.
Three passes over the distinct vectors: sums, centred co-moments, co-moments of the result.
Tasks add up their rows in numpy and hand over one row for each matrix entry; only sums as
wide as the embedding reach the driver, where ``eigen`` finds the components. These are
broadcast, and every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallybook.llm.eigen import leading_pairs
from tallybook.llm.shared import fresh, saved

SCALE = 256
COMPONENTS = 4
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What the projection needs: ``mean`` is ``sums / n``, components are columns."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    total: float
    identity_error: float | None = None

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows ``x`` less the mean: whole part exactly, fraction in double precision."""
        whole, part = _mean(self.n, self.sums)
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums)^2 for each row, exact; None beyond a long."""
        whole, _ = _mean(self.n, self.sums)
        rest = np.array([s - self.n * int(w) for s, w in zip(self.sums, whole)], object)
        y = x - whole
        largest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if self.width * largest**2 <= _LONG:
            return ((self.n * y - rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - rest) ** 2).sum(1)
        return [v if v <= _LONG else None for v in exact]


def _mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Mean as whole numbers and fractions of one."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def whole_vector(vector: str, scale: int = SCALE):
    """``floor(scale * entry)`` of every entry; null for a vector with an unusable entry.

    Entries of over 2^61 / ``scale`` in size count as unusable too: their sums and
    differences would not stay exact.
    """
    entries = F.col(f"`{vector}`").cast("array<double>")
    # a comparison with null is null, and NaN is greater than everything
    usable = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= (1 << 61) / scale, F.lit(False)))
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * scale)))


def fit_list(x: DataFrame) -> tuple[DataFrame, int]:
    """The distinct vectors of ``x`` (x) of the usual length, written once, and that length.

    The usual length is the one that most distinct vectors have, the longest of several.
    """
    distinct = saved(x.where(F.col("x").isNotNull()).distinct(), "vectors")
    usual = (
        distinct.groupBy(F.size("x").alias("width"))
        .agg(F.count("*").alias("n"))
        .agg(F.max(F.struct("n", "width")).alias("m"))
        .first()
    )
    width = usual["m"]["width"] if usual["m"] else 0
    return distinct.where(F.size("x") == width), width


def _block(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _added(
    fit: DataFrame, width: int, add: Callable[[np.ndarray], np.ndarray], kind: str = "double"
) -> np.ndarray:
    """Sum over all blocks of rows of what ``add`` gives, a flat array of numbers."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_block(batch.column(0), width))
                total = part if total is None else total + part
        if total is not None:
            at = pa.array(np.arange(len(total)), pa.int64())
            values = pa.array(total.tolist()).cast(pa.float64()) if kind == "double" else pa.array(map(str, total), pa.string())
            yield pa.RecordBatch.from_arrays([at, values], ["at", "value"])

    of_task = "double" if kind == "double" else "string"
    sums = fit.select("x").mapInArrow(tasks, f"at long, value {of_task}").groupBy("at")
    rows = sums.agg(F.sum(F.col("value").cast(kind)).alias("value")).orderBy("at").collect()
    return np.array([r["value"] for r in rows])


def _exact_sums(block: np.ndarray) -> np.ndarray:
    small = int(np.abs(block).max(initial=0)) * len(block) < 1 << 62
    return (block if small else block.astype(object)).sum(0).astype(object)


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The transform fitted to the rows of ``fit`` (x: arrays of ``width``); None without rows.

    It has fewer than ``components`` components where the rows have a lower rank.
    """
    n = fit.count() if width else 0
    if not n:
        return None
    sums = [int(s) for s in _added(fit, width, _exact_sums, "decimal(38,0)")]
    start = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    upper = np.triu_indices(width)

    def co_moments(block: np.ndarray) -> np.ndarray:
        d = start.centred(block)
        return (d.T @ d)[upper]

    covariance = np.zeros((width, width))
    covariance[upper] = _added(fit, width, co_moments) / n
    covariance = covariance + np.triu(covariance, 1).T
    values, basis = leading_pairs(covariance, components)
    model = Whitening(n, sums, values, basis, float(np.trace(covariance)))
    return Whitening(
        n, sums, values, basis, model.total, identity_error(fit, model) if len(values) else None
    )


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, measured."""
    k = len(model.variances)
    mean = _added(fit, model.width, lambda block: model.whitened(block).sum(0)) / model.n

    def co_moments(block: np.ndarray) -> np.ndarray:
        d = model.whitened(block) - mean
        return (d.T @ d).ravel()

    found = _added(fit, model.width, co_moments).reshape(k, k) / model.n
    return float(np.abs(found - np.eye(k)).max())


def whitening_report(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each row and component.

    Rows whose vector is null, or has a null, non-finite or huge entry (over 2^61 / ``scale``),
    are left out. The fit is over the distinct whole vectors of the usual length, so
    repeated rows weigh once but are all returned; rows of another length come back once for each
    component, with null deviation and whitened value. A deviation beyond a long is null.
    Components are numbered from 1 by falling variance; equal variances give some orthogonal
    choice, the same for all rows. Data of a lower rank have fewer components, and an empty table,
    a single different vector or vectors without entries have none, so no rows. Null and repeated keys are kept.
    identity_error is measured, not assumed: it is near 1e-15 as long as the kept variances lie within ten orders of size.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType
    key_name = fresh(["x"], key)
    rows = df.select(F.col(f"`{key}`").alias(key_name), whole_vector(vector, scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    schema = StructType(
        [StructField(key, kind)]
        + StructType.fromDDL(
            "component int, n long, deviation long, whitened double, explained double, identity_error double"
        ).fields
    )
    fit, width = fit_list(rows.select("x"))
    model = fit_whitening(fit, width, components)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, explained = len(m.variances), m.variances / m.total
        for batch in batches:
            x, count = batch.column(1), batch.num_rows
            usual = np.flatnonzero(x.value_lengths().to_numpy(zero_copy_only=False) == m.width)
            block = _block(x.take(pa.array(usual)), m.width)
            deviation = np.full(count, None, object)
            deviation[usual] = m.deviations(block)
            white = np.full((count, k), np.nan)
            white[usual] = m.whitened(block)
            other = np.isin(np.arange(count), usual, invert=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(count), k))),
                    pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                    pa.array(np.full(count * k, m.n), pa.int64()),
                    pa.array(np.repeat(deviation, k), pa.int64()),
                    pa.array(white.ravel(), pa.float64(), mask=np.repeat(other, k)),
                    pa.array(np.tile(explained, count), pa.float64()),
                    pa.array(np.full(count * k, m.identity_error), pa.float64()),
                ],
                schema.names,
            )

    return rows.mapInArrow(project, schema)
