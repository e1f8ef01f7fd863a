"""Ledgers of dates: which were read, which were processed, what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUCCESS = "success"
FAILED = "failed"


def first_write_wins(updates: DataFrame, key: str = "date", order: str = "ts") -> DataFrame:
    """Ledger state after ordered updates: a forced write always applies, an
    unforced one only while the date is still unknown.

    So the last forced update stands, or else the very first one. Two ordered
    extremes per date, both pre-aggregated before the shuffle.
    """
    entry = F.struct("status", "games_count", order)
    rank = F.struct(order, "status", "games_count")
    return (
        updates.groupBy(key)
        .agg(
            F.max_by(entry, F.when(F.col("force"), rank)).alias("forced"),
            F.min_by(entry, rank).alias("first"),
        )
        .select(key, F.coalesce("forced", "first").alias("entry"))
        .select(key, "entry.*")
    )


def last_write_wins(updates: DataFrame, keys: list[str], order: str = "ts") -> DataFrame:
    """Newest update per key."""
    rest = [c for c in updates.columns if c not in keys and c != order]
    newest = F.max(F.struct(order, *rest)).alias("entry")
    return updates.groupBy(*keys).agg(newest).select(*keys, "entry.*")


def conversion_status(updates: DataFrame, keys: list[str], order: str = "ts") -> DataFrame:
    """Newest status per key; the version is the newest one that was given."""
    return updates.groupBy(*keys).agg(
        F.max_by("status", F.struct(order, "status")).alias("status"),
        F.max_by("version", F.when(F.col("version").isNotNull(), F.struct(order, "version"))).alias("version"),
        F.max(order).alias("last_updated"),
    )


def date_set(df: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates, ready to be looked up; Spark broadcasts them by their measured size."""
    return df.select(date).distinct()


def done_dates(ledger: DataFrame, stage: str | None = None) -> DataFrame:
    """Distinct dates recorded as successful."""
    done = ledger.where(F.col("status") == SUCCESS)
    if stage is not None:
        done = done.where(F.col("stage") == stage)
    return date_set(done)


def unprocessed_dates(ledger: DataFrame, before: str = "scraping", after: str = "processing") -> DataFrame:
    """Dates that finished one stage and not the next."""
    return done_dates(ledger, before).join(done_dates(ledger, after), "date", "left_anti").orderBy("date")


def skip_done(inputs: DataFrame, ledger: DataFrame, stage: str | None = None, force: bool = False) -> DataFrame:
    """Inputs whose date is not recorded as successful; ``force`` keeps all."""
    return inputs if force else inputs.join(done_dates(ledger, stage), "date", "left_anti")


def ledger_summary(ledger: DataFrame, *keys: str) -> DataFrame:
    """Number and sorted list of successful dates per key.

    The list holds each calendar day once, so its size is bounded by the
    calendar and not by the number of ledger rows.
    """
    days = ledger.where(F.col("status") == SUCCESS).select(*keys, "date").distinct()
    return days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_dates"), F.sort_array(F.collect_list("date")).alias("completed_dates")
    )


def rows_from_map(documents: DataFrame, column: str, *keep: str) -> DataFrame:
    """``map<date, struct<status, games_count, timestamp>>`` to one row per date."""
    return documents.select(*keep, F.explode(column).alias("date", "entry")).select(
        *keep,
        F.col("date"),
        (F.col("entry.status") == SUCCESS).alias("success"),
        F.coalesce("entry.games_count", F.lit(0)).cast("bigint").alias("games_count"),
        F.col("entry.timestamp").alias("timestamp"),
    )


def map_from_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Back to one map per key. Dates are unique per key, so the calendar bounds the map."""
    status = F.when(F.col("success"), F.lit(SUCCESS)).otherwise(F.lit(FAILED))
    entry = F.struct(
        status.alias("status"),
        F.coalesce("games_count", F.lit(0)).cast("bigint").alias("games_count"),
        F.col("timestamp"),
    )
    per_date = rows.groupBy(*keys, "date").agg(F.max(F.struct("timestamp", "success", "games_count")).alias("e"))
    unique = per_date.select(*keys, "date", "e.*")
    return unique.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("date", entry.alias("entry"))))).alias(
            "completed_dates"
        )
    )


def _marker(name: Column, suffix: str) -> Column:
    return F.coalesce(F.max(F.endswith(name, F.lit(suffix))), F.lit(False))


def backfill_status(listing: DataFrame, *keys: str, path: str = "key") -> DataFrame:
    """State of a backfill per prefix, from its marker files and file count."""
    name = F.col(path)
    data_file = F.endswith(name, F.lit(".json")) | F.endswith(name, F.lit(".jsonl"))
    return (
        listing.groupBy(*keys)
        .agg(
            F.count_if(data_file).alias("files_count"),
            _marker(name, "backfill_in_progress.marker").alias("in_progress_marker"),
            _marker(name, "backfill_completed.marker").alias("completed_marker"),
        )
        .withColumn(
            "status",
            F.when(F.col("completed_marker"), "COMPLETED")
            .when(F.col("in_progress_marker"), "IN_PROGRESS")
            .when(F.col("files_count") > 0, "COMPLETED")
            .otherwise("NOT_STARTED"),
        )
    )
