"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.scratch import staged

POSITION = "__llm_position"
ARROW_ROWS = 1000
_ROW_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def short_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Arrow batches to Python hold at most ``rows`` rows in what runs meanwhile, so long texts make no large ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread_small(df: DataFrame) -> DataFrame:
    """A hint that lets adaptive execution even out partitions before heavy work per row."""
    return df.hint("rebalance")


def positioned(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows in a global order, staged, with ``POSITION`` = partition number << 33 | row number there.

    Rows are dealt out by range, so no task sees more than its share, and the
    stored copy fixes the positions for every later reader. The order must
    name enough columns to be total for results to repeat.
    """
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order)
    return staged(ranged.withColumn(POSITION, F.monotonically_increasing_id()), "positioned")


def part_of(position: Column) -> Column:
    """Number of the range a position lies in."""
    return F.shiftright(position, _ROW_BITS)


def row_in_part(position: Column) -> Column:
    """Number of the row inside its range."""
    return position.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
