"""Hand-made bronze rows for the edge cases (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from stockbook.sources.bronze import conform
from stockbook.sources.schemas import BRONZE_SCHEMAS


def D(s: str | None) -> dt.date | None:
    return None if s is None else dt.date.fromisoformat(s)


def T(s: str | None) -> dt.datetime | None:
    return None if s is None else dt.datetime.fromisoformat(s)


def frame(spark, table: str, rows: list[tuple]):
    return conform(spark.createDataFrame(rows, BRONZE_SCHEMAS[table]), table)


def countries(spark, rows=None):
    rows = rows or [(1, "EUROPE", "POLAND", "C1", T("2024-01-01 00:00:00")),
                    (2, "EUROPE", "GERMANY", "C1", T("2024-01-01 00:00:00"))]
    return frame(spark, "countries", rows)


def customers(spark, rows=None):
    rows = rows or [(10, 1, "Apteka A", "addr", "Warsaw", T("2024-01-01 00:00:00")),
                    (20, 2, "Apotheke B", "addr", "Berlin", T("2024-01-01 00:00:00"))]
    return frame(spark, "customers", rows)
