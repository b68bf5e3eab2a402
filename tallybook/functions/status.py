"""Vendor status normalisation: one small rule object per service."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions._cols import ColumnOrName, as_col
from tallybook.functions.labels import label_or
from tallybook.functions.text import strip

SUCCESS, FAILED, TIMED_OUT = "success", "failed", "timed out"
INITIATED = "initiated"


@dataclass(frozen=True)
class KeepStatus:
    """Vendor text used as it is, only stripped (or not even that)."""

    strip: bool = True

    def apply(self, c: ColumnOrName) -> Column:
        return strip(c) if self.strip else as_col(c)


@dataclass(frozen=True)
class ExactStatus:
    """Exact text to status; unlisted text and null give ``other``."""

    names: Mapping[str, str]
    other: str = FAILED

    def apply(self, c: ColumnOrName) -> Column:
        return label_or(c, self.names, self.other)


@dataclass(frozen=True)
class ContainsStatus:
    """``found`` if the text holds ``word`` in any case, else (null included) ``other``."""

    word: str
    found: str
    other: str

    def apply(self, c: ColumnOrName) -> Column:
        hit = F.contains(F.lower(as_col(c)), F.lit(self.word))
        return F.when(hit, F.lit(self.found)).otherwise(F.lit(self.other))


@dataclass(frozen=True)
class EqualsStatus:
    """``found`` if the text equals ``word`` in any case, else (null included) ``other``."""

    word: str
    found: str
    other: str

    def apply(self, c: ColumnOrName) -> Column:
        hit = F.lower(as_col(c)) == self.word
        return F.when(hit, F.lit(self.found)).otherwise(F.lit(self.other))


StatusRule = KeepStatus | ExactStatus | ContainsStatus | EqualsStatus


def lower_status(c: ColumnOrName) -> Column:
    """Form in which statuses and ledger flags are compared."""
    return F.lower(strip(c))
