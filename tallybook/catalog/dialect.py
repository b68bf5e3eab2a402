"""The few places where Spark SQL and the checking engine spell the same thing differently."""

from __future__ import annotations

_LAYOUTS = {
    "yyyy-MM-dd": "%Y-%m-%d",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "dd-MMM-yyyy HH:mm:ss": "%d-%b-%Y %H:%M:%S",
    "dd-MM-yyyy HH:mm": "%d-%m-%Y %H:%M",
    "dd-MM-yyyy": "%d-%m-%Y",
    "dd/MM/yyyy": "%d/%m/%Y",
    "MM/dd/yyyy": "%m/%d/%Y",
    "ddMMyyyy": "%d%m%Y",
}


class SparkDialect:
    def name(self, identifier: str) -> str:
        return f"`{identifier}`"

    def text(self, stamp: str, layout: str) -> str:
        return f"date_format({stamp}, '{layout}')"

    def add_days(self, day: str, days: str) -> str:
        return f"date_add({day}, CAST({days} AS INT))"

    def table(self, name: str) -> str:
        return "{" + name + "}"


class DuckDialect:
    def name(self, identifier: str) -> str:
        return f'"{identifier}"'

    def text(self, stamp: str, layout: str) -> str:
        return f"strftime({stamp}, '{_LAYOUTS[layout]}')"

    def add_days(self, day: str, days: str) -> str:
        return f"({day} + CAST({days} AS INT))"

    def table(self, name: str) -> str:
        return name


SPARK, DUCK = SparkDialect(), DuckDialect()
Dialect = SparkDialect | DuckDialect
