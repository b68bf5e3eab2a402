"""Run counts without materialising the match.

The number of matched pairs in a bucket is, per key, the number of hub rows
that fit the bucket's hub part times the number of vendor rows that fit its
vendor part. Both sides are therefore reduced to one row per key first (with
map-side partial aggregation, so a hot key costs nothing extra) and only those
rows are joined. The join reuses the partitioning of the two aggregations: one
shuffle per side, whatever the number of buckets and counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions._cols import as_col
from tallybook.functions.status import FAILED, SUCCESS, TIMED_OUT, lower_status
from tallybook.operators.columns import union_aligned
from tallybook.operators.match import exact, key_set, stripped
from tallybook.operators.rules import (
    NOT_IN_PORTAL,
    NOT_IN_VENDOR,
    UNCLASSIFIED,
    Rule,
)

_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class MatchColumns:
    """Names of the columns a two-sided match works on."""

    hub_key: str = "VENDOR_REFERENCE"
    vendor_key: str = "REFID"
    hub_status: str = "IHUB_MASTER_STATUS"
    vendor_status: str = "VENDOR_STATUS"
    ledger: str | None = "IHUB_LEDGER_STATUS"


def count_frame(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """``(metric, value)`` rows from conditions over one frame, in a single aggregation."""
    wide = df.agg(*[F.count_if(cond).alias(name) for name, cond in counts.items()])
    return to_metrics(wide)


def to_metrics(wide: DataFrame) -> DataFrame:
    """One-row frame turned into ``(metric, value)`` rows."""
    return wide.unpivot([], wide.columns, "metric", "value")


def _side(df: DataFrame, key: Column, tests: Mapping[str, Column]) -> DataFrame:
    keyed = df.select(key.alias("__key"), *[t.alias(n) for n, t in tests.items()])
    return keyed.groupBy("__key").agg(*[F.count_if(F.col(n)).alias(n) for n in tests])


def pair_counts(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    pairs: Mapping[str, tuple[Column, Column]],
    form=exact,
) -> DataFrame:
    """Number of matched pairs that pass a test on each side, per name, as ``(metric, value)`` rows."""
    a = _side(left, form(left_key), {f"l{i}": t[0] for i, t in enumerate(pairs.values())})
    b = _side(right, form(right_key), {f"r{i}": t[1] for i, t in enumerate(pairs.values())})
    wide = a.join(b, "__key").agg(
        *[
            _total(F.col(f"l{i}").cast(_WIDE) * F.col(f"r{i}")).alias(name)
            for i, name in enumerate(pairs)
        ]
    )
    return to_metrics(wide)


def one_if(test: Column) -> Column:
    """1 where the test holds, else 0."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def stacked_sums(
    keys: Sequence[str], *sides: tuple[DataFrame, Sequence[Column], Mapping[str, Column]]
) -> DataFrame:
    """One row per key with sums from several frames, each ``(frame, key columns, numbers by name)``.

    The frames are stacked, not joined: one grouping, whose map tasks reduce a hot key to
    one row, says what each frame has of a key, and 0 for those that do not have it. Null keys form a
    group like any other.
    """
    names = [name for *_, numbers in sides for name in numbers]
    parts = [
        frame.select(
            *[form.alias(key) for key, form in zip(keys, forms, strict=True)],
            *[numbers.get(name, F.lit(0)).cast("bigint").alias(name) for name in names],
        )
        for frame, forms, numbers in sides
    ]
    return union_aligned(*parts).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def product(*names: str) -> Column:
    """Product of counts, wide enough for pairs of any two tables."""
    return reduce(lambda a, b: a * b, [F.col(n).cast(_WIDE) for n in names])


def totals(df: DataFrame, numbers: Mapping[str, Column]) -> DataFrame:
    """``(metric, value)`` rows: sums of numbers over a frame, 0 of an empty one."""
    return to_metrics(df.agg(*[_total(number).alias(name) for name, number in numbers.items()]))


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast(_WIDE)), F.lit(0).cast(_WIDE)).cast("bigint")


def match_summary(
    hub: DataFrame,
    vendor: DataFrame,
    rules: Sequence[Rule],
    cols: MatchColumns = MatchColumns(),
    key_mode: str = "strip",
    late_is_failed: bool = True,
) -> DataFrame:
    """Bucket sizes and run counts as ``(metric, value)`` rows.

    ``key_mode`` is ``strip`` (keys compared stripped everywhere) or
    ``reference`` (the match and NOT_IN_PORTAL compare keys as stored, only
    NOT_IN_VENDOR strips them). ``late_is_failed`` lets a vendor time-out count
    towards Total_Failed_count.
    """
    form = stripped if key_mode == "strip" else exact
    h, v = lower_status(cols.hub_status), lower_status(cols.vendor_status)
    led = None if cols.ledger is None else lower_status(cols.ledger)
    vendor_failed = (FAILED, TIMED_OUT) if late_is_failed else (FAILED,)

    hub_tests = {
        "h_rows": F.lit(True),
        "h_open": h.isin("initiated", "inprogress"),
        "h_success": h == SUCCESS,
        "h_failed": h == FAILED,
    }
    vendor_tests = {
        "v_rows": F.lit(True),
        "v_success": v == SUCCESS,
        "v_failed": v == FAILED,
        "v_late": v == TIMED_OUT,
        "v_not_ok": v.isin(*vendor_failed),
    }
    for i, rule in enumerate(rules):
        hub_tests[f"h{i}"] = rule.hub_test(h, led)
        vendor_tests[f"v{i}"] = rule.vendor_test(v)

    a = _side(hub, form(cols.hub_key), hub_tests)
    b = _side(vendor, form(cols.vendor_key), vendor_tests)
    keys = a.join(b, "__key", "full")

    c = F.col
    pairs = {"matched": ("h_rows", "v_rows")}
    pairs["Total_Success_count"] = ("h_success", "v_success")
    pairs["Total_Failed_count"] = ("h_failed", "v_not_ok")
    pairs |= {rule.category: (f"h{i}", f"v{i}") for i, rule in enumerate(rules)}
    singles = {
        "HUB_Value_count": "h_rows",
        "Excel_value_count": "v_rows",
        "Hub_initiated_count": "h_open",
        "Hub_success_count": "h_success",
        "Hub_failed_count": "h_failed",
        "Vendor_success_count": "v_success",
        "Vendor_failed_count": "v_failed",
        "Vendor_timeout_count": "v_late",
    }
    wide = keys.agg(
        *[_total(c(x).cast(_WIDE) * c(y)).alias(n) for n, (x, y) in pairs.items()],
        *[_total(c(x)).alias(n) for n, x in singles.items()],
        _total(F.when(c("h_rows").isNull(), c("v_rows"))).alias(NOT_IN_PORTAL),
        _total(F.when(c("v_rows").isNull(), c("h_rows"))).alias(NOT_IN_VENDOR),
    )
    covered = sum((c(r.category) for r in rules), start=F.lit(0).cast("bigint"))
    wide = wide.withColumn(UNCLASSIFIED, c("matched") - covered)
    if key_mode == "strip":
        return to_metrics(wide)
    return to_metrics(wide.drop(NOT_IN_VENDOR)).unionByName(
        _unmatched_stripped(hub, vendor, cols)
    )


def _unmatched_stripped(
    hub: DataFrame, vendor: DataFrame, cols: MatchColumns
) -> DataFrame:
    per_key = hub.groupBy(stripped(cols.hub_key).alias("__key")).agg(
        F.count("*").alias("n")
    )
    missing = per_key.join(key_set(vendor, cols.vendor_key), "__key", "left_anti")
    return missing.agg(_total(F.col("n")).alias("value")).select(
        F.lit(NOT_IN_VENDOR).alias("metric"), "value"
    )


def bucket_sizes(buckets: DataFrame, by: str = "CATEGORY") -> DataFrame:
    """Row count per bucket of an already built result."""
    return buckets.groupBy(as_col(by)).agg(F.count("*").alias("n"))
