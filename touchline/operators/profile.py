"""Column profiles: missing values, distinct values, summaries.

Everything per column is computed for all columns at once. Exact quantiles are
taken from value counts dealt into ranges, so no task has to hold a whole column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.scratch import staged


def value_counts(df: DataFrame, columns: list[str], type_name: str) -> DataFrame:
    """Occurrences of every non-null value: ``(column, value, n)``.

    Values are counted on the map side first, so a value that fills a third of
    the table reaches the shuffle as one row per task.
    """
    cast = df.select(*[F.col(c).cast(type_name).alias(c) for c in columns])
    return (
        cast.unpivot([], columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _one_row_per_column(wide: DataFrame, columns: list[str], parts: list[str]) -> DataFrame:
    """Turn a single aggregate row with ``<column>__<part>`` fields into rows."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{i}__{p}").alias(p) for p in parts])
            for i, c in enumerate(columns)
        ]
    )
    return wide.select("total", F.inline(rows))


def missing_by_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percentage of every column, in one pass."""
    columns = columns or df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"{i}__missing") for i, c in enumerate(columns)],
    )
    pct = F.round(F.try_divide(F.col("missing") * 100.0, F.col("total")), 2)
    return (
        _one_row_per_column(wide, columns, ["missing"])
        .select("column", "missing", pct.alias("missing_pct"))
        .orderBy(F.desc("missing"), "column")
    )


def high_missing(df: DataFrame, limit: float = 20.0, columns: list[str] | None = None) -> DataFrame:
    """Columns of which more than ``limit`` percent are null."""
    return missing_by_column(df, columns).where(F.col("missing_pct") > limit)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct non-null values per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.countDistinct(c).alias(f"{i}__distinct_values") for i, c in enumerate(columns)],
    )
    return _one_row_per_column(wide, columns, ["distinct_values"]).drop("total")


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Type, distinct values and missing values of every column."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"{i}__missing") for i, c in enumerate(columns)],
        *[F.countDistinct(c).alias(f"{i}__distinct_values") for i, c in enumerate(columns)],
    )
    kind = F.element_at(F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])]), F.col("column"))
    pct = F.round(F.try_divide(F.col("missing") * 100.0, F.col("total")), 2)
    return _one_row_per_column(wide, columns, ["missing", "distinct_values"]).select(
        "column", kind.alias("data_type"), "distinct_values", "missing", pct.alias("missing_pct")
    )


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency."""
    first = F.struct((-F.col("n")).alias("n"), F.col("value"))
    return (
        value_counts(df, columns, "string")
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by("value", first).alias("top"),
            F.max("n").alias("freq"),
        )
    )


def exact_quantiles(df: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column.

    Value counts are dealt into ranges of about equal size, however the values
    lie, and stored, which fixes the ranges. Totals per column and range give
    every range its offset, and a running sum inside each range places every
    value, so no task holds more than its share of a column.
    """
    counts = staged(value_counts(df, columns, "double"), "value_counts")
    dealt = counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
    dealt = staged(dealt, "value_ranges")
    sums = dealt.groupBy("column", "part").agg(F.sum("n").alias("in_part"))
    order = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "column",
        "part",
        F.coalesce(F.sum("in_part").over(order), F.lit(0)).alias("offset"),
        F.sum("in_part").over(Window.partitionBy("column")).alias("total"),
    )
    inside = Window.partitionBy("column", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # At most one row per range and one more per column.
    placed = dealt.join(F.broadcast(offsets), ["column", "part"]).select(
        "column",
        "value",
        "total",
        (F.col("offset") + F.sum("n").over(inside)).alias("after"),
        "n",
    )

    def at(position):
        hit = (F.col("after") - F.col("n") <= position) & (position < F.col("after"))
        return F.max(F.when(hit, F.col("value")))

    parts = []
    for name, q in points.items():
        rank = (F.col("total") - 1) * F.lit(q)
        parts += [
            at(F.floor(rank)).alias(f"{name}__low"),
            at(F.ceil(rank)).alias(f"{name}__high"),
            F.max(rank - F.floor(rank)).alias(f"{name}__part"),
        ]
    picked = placed.groupBy("column").agg(*parts)
    return picked.select(
        "column",
        *[
            (F.col(f"{n}__low") + (F.col(f"{n}__high") - F.col(f"{n}__low")) * F.col(f"{n}__part")).alias(n)
            for n in points
        ],
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the named columns, or of all that hold numbers."""
    columns = columns or numeric_columns(df)
    measures = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            measure(F.col(c).cast("double")).alias(f"{i}__{name}")
            for i, c in enumerate(columns)
            for name, measure in measures.items()
        ],
    )
    moments = _one_row_per_column(wide, columns, list(measures)).drop("total")
    quartiles = exact_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "column", "left")


def match_rates(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """How many rows match each pattern, and their share of all rows."""
    names = list(patterns)
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(column).rlike(p)).alias(f"{i}__matches") for i, p in enumerate(patterns.values())],
    )
    pct = F.round(F.try_divide(F.col("matches") * 100.0, F.col("total")), 2)
    return _one_row_per_column(wide, names, ["matches"]).select(
        F.col("column").alias("pattern"), "matches", pct.alias("pct")
    )
