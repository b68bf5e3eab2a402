from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    """Column from a name; names are quoted so that dots and spaces are taken literally."""
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def once(value: Column, form: Callable[[Column], Column]) -> Column:
    """``form(value)``, with ``value`` computed once however often ``form`` uses it.

    Spark writes an expression out at each place where it is used, so text that is cleaned in
    several steps would be cleaned many times over. A variable of a lambda function is computed once.
    """
    return F.transform(F.array(value), form)[0]
