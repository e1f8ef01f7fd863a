"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Columns in types that two engines print alike: dates, stamps and lists as text, integers as bigint."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "|")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(function(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def day_sql(expression: str) -> str:
    """A date as the text that :func:`portable` gives."""
    return f"strftime({expression}, '%Y-%m-%d')"


def stamp_sql(expression: str) -> str:
    """A stamp as the text that :func:`portable` gives."""
    return f"strftime(CAST({expression} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
