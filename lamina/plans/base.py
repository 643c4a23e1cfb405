"""Where queries and their equivalents in SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Register a query under its function's name, with the same in SQL."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def dec(c, digits: int = 4):
    """Rounded, so that the order of additions doesn't show."""
    return F.round(c, digits)


def pick(index: Column, values: list) -> Column:
    """The value of a list at a place that a column gives."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def shown(cells: Column) -> Column:
    """An array as one text, as engines compare texts alike."""
    return F.array_join(F.transform(cells, lambda x: x.cast("string")), "|", "")


def sql_pick(index: str, values: list) -> str:
    """The same in SQL."""
    return "[" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in values) + f"][CAST({index} AS INTEGER) + 1]"
