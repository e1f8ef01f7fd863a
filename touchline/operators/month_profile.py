"""Column profiles kept as partial aggregates per month and merged on demand.

A month's partials are small: per numeric column the row, null and value
counts, the sum, the mean and the sum of squared deviations, the minimum and
maximum and a HyperLogLog sketch of the values; per text column the count of
every value (null included). A profile of any set of months merges them:
counts add, means combine by weight, squared deviations by the parallel rule
(each month's own plus its count times the squared distance of its mean from
the merged mean), so no value is read again. After a correction only the
touched months are recomputed (``refresh``) and put beside the stored rest,
so its cost follows the months it touches, not the table.

A month that holds a third of the rows is counted on the map side first
(partial aggregation), so it reaches the shuffle as one row per task and
column. Text value counts grow with the distinct values of a column and month,
not with its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_partials(df: DataFrame, month: Column, numeric: list[str], text: list[str]) -> tuple[DataFrame, DataFrame]:
    """Partials per month: ``(moments, values)``.

    ``moments``: month, column, rows, n (non-null), total, mean, m2 (sum of
    squared deviations from the month's mean), lo, hi, sketch (HyperLogLog of
    the values as text). ``values``: month, column, value (null: missing), n.
    A null month is its own month. Empty input gives empty tables.
    """
    rows = df.select(month.alias("month"), *[F.col(c) for c in dict.fromkeys([*numeric, *text])])
    moments = values = None
    if numeric:
        long = rows.select("month", *[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(["month"], numeric, "column", "value")
        value = F.col("value")
        moments = long.groupBy("month", "column").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
            F.hll_sketch_agg(value.cast("string")).alias("sketch"),
        )
    if text:
        long = rows.select("month", *[F.col(c).cast("string").alias(c) for c in text]).unpivot(["month"], text, "column", "value")
        values = long.groupBy("month", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return moments, values


def refresh(stored: DataFrame, fresh: DataFrame, touched: list[str]) -> DataFrame:
    """Stored partials of the untouched months beside fresh ones of ``touched``.

    ``fresh`` holds the recomputed partials of the touched months (months of
    ``fresh`` outside ``touched`` are ignored). ``None`` in ``touched`` stands
    for the rows without a month. A touched month that has no rows any more
    simply disappears.
    """
    named = [m for m in touched if m is not None]
    hit = F.coalesce(F.col("month").isin(named), F.lit(False)) if named else F.lit(False)
    if None in touched:
        hit = hit | F.col("month").isNull()
    return stored.where(~hit).unionByName(fresh.where(hit))


PROFILE = (
    "column string, rows long, missing long, count long, mean double, std double, min double, max double, "
    "approx_unique long, unique long, top string, freq long"
)


def merge_numeric(moments: DataFrame) -> DataFrame:
    """One profile row per numeric column from partials of any months.

    ``std`` is the sample deviation (null below two values); ``mean``, ``min``
    and ``max`` are null without values. ``approx_unique`` comes from the
    merged sketches; ``unique``, ``top`` and ``freq`` are null.
    """
    merged = moments.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("count"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("mean"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("approx_unique"),
    )
    # The parallel rule: each month's squared deviations plus its count times its mean's squared distance.
    spread = moments.join(merged.select("column", F.col("mean").alias("__all")), "column")
    part = F.when(F.col("n") > 0, F.col("m2") + F.col("n") * (F.col("mean") - F.col("__all")) ** 2).otherwise(F.lit(0.0))
    m2 = spread.groupBy("column").agg(F.sum(part).alias("__m2"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("__m2") / (F.col("count") - 1)))
    none = F.lit(None)
    return merged.join(m2, "column").select(
        "column", "rows", (F.col("rows") - F.col("count")).alias("missing"), "count", "mean", std.alias("std"), "min", "max",
        "approx_unique", none.cast("long").alias("unique"), none.cast("string").alias("top"), none.cast("long").alias("freq"),
    )


def merge_text(values: DataFrame) -> DataFrame:
    """One profile row per text column: counts, exact distinct values and the most frequent value.

    Ties of the most frequent value go to the smallest one; a column without
    values has null ``top`` and ``freq`` and ``unique`` 0.
    """
    counts = values.groupBy("column", "value").agg(F.sum("n").alias("n"))
    present = F.col("value").isNotNull()
    merged = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).cast("long").alias("missing"),
        F.count(F.when(present, F.lit(1))).alias("unique"),
        F.min(F.when(present, F.struct((-F.col("n")).alias("k"), F.col("value").alias("v")))).alias("__top"),
    )
    none = F.lit(None)
    return merged.select(
        "column", "rows", "missing", (F.col("rows") - F.col("missing")).alias("count"),
        *[none.cast("double").alias(c) for c in ("mean", "std", "min", "max")],
        F.col("unique").alias("approx_unique"), "unique", F.col("__top.v").alias("top"), (-F.col("__top.k")).alias("freq"),
    )


def merge(moments: DataFrame | None, values: DataFrame | None) -> DataFrame:
    """Profiles of all columns of the partials given, numeric first, in :data:`PROFILE` form."""
    parts = ([merge_numeric(moments)] if moments is not None else []) + ([merge_text(values)] if values is not None else [])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
