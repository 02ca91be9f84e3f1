"""Bronze readers.

A ``Bronze`` bundle holds one lazy DataFrame per source table. Models take
the bundle (or single frames) as arguments, so the same code runs on parquet
folders, catalog tables or frames built in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.sources.schemas import BRONZE_SCHEMAS


class Bronze:
    """The eight bronze tables, each a DataFrame or a zero-argument factory.

    Factories run on first access only, so a query that needs two tables
    never builds (or lists files for) the other six.
    """

    TABLES = tuple(BRONZE_SCHEMAS)

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]) -> None:
        unknown = set(tables) - set(self.TABLES)
        missing = set(self.TABLES) - set(tables)
        if unknown or missing:
            raise TypeError(f"bronze tables: unknown {sorted(unknown)}, missing {sorted(missing)}")
        self._src = dict(tables)
        self._done: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.TABLES:
            raise AttributeError(name)
        if name not in self._done:
            src = self._src[name]
            self._done[name] = src() if callable(src) else src
        return self._done[name]

    def source(self, name: str) -> DataFrame | Callable[[], DataFrame]:
        return self._src[name]

    def with_tables(self, **frames: DataFrame) -> "Bronze":
        return Bronze(**{**self._src, **frames})

    def names(self) -> list[str]:
        return list(self.TABLES)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the bronze columns in order, cast to the declared types.

    Casts are ANSI: text that is not a date or number fails the job instead of
    turning into NULL.
    """
    schema = BRONZE_SCHEMAS[table]
    return df.select([F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def read_bronze(spark: SparkSession, root: str, fmt: str = "parquet") -> Bronze:
    """Read ``{root}/{table}`` for every bronze table with an explicit schema."""
    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(BRONZE_SCHEMAS[table]).format(fmt).load(f"{root.rstrip('/')}/{table}")
    return Bronze(**{t: reader(t) for t in BRONZE_SCHEMAS})


def read_bronze_tables(spark: SparkSession, database: str) -> Bronze:
    """Read the bronze tables from a catalog database."""
    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: conform(spark.read.table(f"{database}.{table}"), table)
    return Bronze(**{t: reader(t) for t in BRONZE_SCHEMAS})


def bronze_from_frames(**frames: DataFrame) -> Bronze:
    """Bundle frames (e.g. test fixtures), conforming each to its schema."""
    return Bronze(**{t: conform(df, t) for t, df in frames.items()})
