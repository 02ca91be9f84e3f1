"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_floor(c: Column | str) -> Column:
    """First day of the month, as DATE (``TRUNC(d, 'MM')``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.trunc(col.cast("date"), "MM")


def date_lit(value: str | _dt.date) -> Column:
    """A typed DATE literal."""
    return F.lit(str(value)).cast("date")


def ts_lit(value: str | _dt.datetime) -> Column:
    """A zone-less TIMESTAMP literal (source clocks are TIMESTAMP_NTZ)."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day_sequence(start: str | _dt.date, end: str | _dt.date, name: str = "Date") -> Column:
    """One row per day from ``start`` to ``end`` inclusive, as a generator column.

    Replaces a generator table plus a global row number: no window over one
    partition, the rows come straight out of ``explode``.
    """
    return F.explode(F.sequence(date_lit(start), date_lit(end), F.expr("interval 1 day"))).alias(name)
