"""NULL-sensitive helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_greatest(*cols: Column | str) -> Column:
    """GREATEST that is NULL when any input is NULL.

    Spark's ``greatest`` skips NULLs; the warehouse dialect the models were
    written for returns NULL instead, and the high-water marks depend on it.
    """
    cs = [_col(c) for c in cols]
    all_set = reduce(lambda a, b: a & b, [c.isNotNull() for c in cs])
    return F.when(all_set, F.greatest(*cs))
