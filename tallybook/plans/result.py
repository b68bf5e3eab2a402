"""What a reconciliation returns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.columns import select_existing, union_aligned
from tallybook.operators.summary import bucket_sizes
from tallybook.sources.staging import staged


@dataclass(frozen=True)
class Result:
    """Rows in one frame, told apart by ``CATEGORY``, and ``(metric, value)`` counts. Both lazy.

    ``days``: the comparison of daily totals, of plans that make one. ``unplaced``: input rows
    that no bucket holds, with a ``CATEGORY``, of plans that have such rows. ``rejects``: rows with
    values that cannot be read and lines that do not fit, as ``(SIDE, REASON, RECORD)``. ``whole``: buckets and
    unplaced rows in one frame, of plans that would else make them twice.
    """

    buckets: DataFrame
    counts: DataFrame
    settled: Sequence[str] = ()
    days: DataFrame | None = None
    unplaced: DataFrame | None = None
    rejects: DataFrame | None = None
    whole: DataFrame | None = None

    def bucket(self, category: str) -> DataFrame:
        return self.buckets.where(F.col("CATEGORY") == category)

    def rows(self) -> DataFrame:
        """Buckets and unplaced rows: every input row is in it."""
        if self.whole is not None:
            return self.whole
        return self.buckets if self.unplaced is None else union_aligned(self.buckets, self.unplaced)

    def combined(self) -> DataFrame:
        """The exception report: every row but those of the settled buckets."""
        return self.rows().where(~F.col("CATEGORY").isin(*self.settled))

    def exceptions_kept(self, *names: str) -> Result:
        """The exception report alone, with the listed columns, written once for several uses."""
        report = staged(select_existing(self.combined(), names))
        return Result(report, self.counts, self.settled)

    def sizes(self) -> DataFrame:
        return bucket_sizes(self.buckets)

    def has_exceptions(self) -> bool:
        """Whether the exception report has any row. Runs a job that stops at the first."""
        return not self.combined().select(F.lit(1)).isEmpty()

    def cached(self) -> Result:
        """Keep the rows for several uses; lost blocks are recomputed from the inputs."""
        kept = self.buckets.persist(StorageLevel.MEMORY_AND_DISK)
        return replace(self, buckets=kept, whole=None)
