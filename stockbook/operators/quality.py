"""Data checks that return the offending rows (empty means the check passes).

Every check is a lazy DataFrame, so a caller can count it, show a sample or
write it out; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once; NULLs are not values.

    Returns (value, n_records). Partial counts are combined before the
    shuffle, so a hot value costs one row per map task.
    """
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1``; NULL keys form a group here."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def check_row_rule(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which ``rule`` is true (the rule describes a violation)."""
    return df.filter(rule)


def country_integrity_rule() -> Column:
    """A customer with a country but any country attribute missing."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("country", "region_description", "cluster")])
    return F.col("country_id").isNotNull() & missing


def normalized(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(col))


def orphan_keys(df: DataFrame, key: str, reference: DataFrame, ref_key: str | None = None,
                normalize: bool = False) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``reference`` (left anti join).

    With ``normalize`` both sides compare as ``lower(trim(key))``, the
    comparison used to find catalog objects no model manages.
    """
    ref_key = ref_key or key
    left = normalized(key) if normalize else F.col(key)
    right = (normalized(ref_key) if normalize else F.col(ref_key)).alias("_ref_key")
    ref = reference.select(right)
    return df.join(ref, left == ref["_ref_key"], "left_anti")


def column_tests(df: DataFrame, key: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """Generic column tests as one frame of failures: (test, column, ``key`` value).

    ``not_null`` lists every row whose column is NULL; ``unique`` lists every
    row whose (non-NULL) value occurs more than once. All not_null tests are one
    pass, each unique test one more; an empty result means every test passes.
    """
    parts = []
    if not_null:
        failed = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in not_null]), lambda c: c.isNotNull())
        parts.append(df.select(F.col(key).cast("string").alias("key"), F.explode(failed).alias("column")).select(
            F.lit("not_null").alias("test"), "column", "key"))
    for c in unique:
        dup = check_unique(df, c).select(F.col(c).alias("_v"))
        rows = df.join(dup, df[c] == dup["_v"], "left_semi")
        parts.append(rows.select(
            F.lit("unique").alias("test"), F.lit(c).alias("column"), F.col(key).cast("string").alias("key")))
    return reduce(DataFrame.unionByName, parts)


# Column tests declared for the customer dimension.
CUSTOMER_NOT_NULL = ("customer_id", "country_id", "company_name", "last_update", "update_ts")
CUSTOMER_UNIQUE = ("customer_id",)
