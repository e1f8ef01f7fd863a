"""Roll-ups of job runs and their event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import text


def status_counts(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs per status."""
    return runs.groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("runs"))


def status_rollup(runs: DataFrame, *keys: str, good: str = "SUCCEEDED") -> DataFrame:
    """Whether every run succeeded; no runs at all counts as success."""
    fine = F.coalesce(F.col("status") == good, F.lit(False))
    return runs.groupBy(*keys).agg(
        F.coalesce(F.bool_and(fine), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("runs"),
        F.count_if(fine).alias("succeeded"),
        F.count_if(~fine).alias("not_succeeded"),
    )


def run_summary(days: DataFrame, *keys: str) -> DataFrame:
    """Totals over day results ``(date, success)`` with the failed days listed.

    The list is a set of calendar days, so it does not grow with the row count.
    """
    failed = F.when(~F.col("success"), F.col("date"))
    per_day = days.groupBy(*keys, "date").agg(F.bool_and("success").alias("success"))
    return per_day.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_dates"),
        F.count_if("success").alias("success_count"),
        F.bool_and("success").alias("all_succeeded"),
        F.array_sort(F.collect_list(failed)).alias("failed_dates"),
    )


def state_durations(log: DataFrame, entered: str, exited: str, failed: str) -> DataFrame:
    """Per run and state: when it was entered and left, its status and duration.

    Only what happened after the last entry counts. An exit outranks a failure.
    """

    def last(kind: str):
        of_kind = F.when(F.col("type") == kind, F.struct("id", "timestamp"))
        return F.max(of_kind)

    marks = log.groupBy("run_id", "state").agg(
        last(entered).alias("enter"), last(exited).alias("exit"), last(failed).alias("fail")
    )
    after = lambda mark: F.when(F.col(f"{mark}.id") > F.col("enter.id"), F.col(f"{mark}.timestamp"))
    timed = marks.where(F.col("enter").isNotNull()).select(
        "run_id",
        "state",
        F.col("enter.timestamp").alias("entered_at"),
        after("exit").alias("exited_at"),
        after("fail").alias("failed_at"),
    )
    end = F.coalesce("exited_at", "failed_at")
    spent = text.duration_text(text.seconds_between(F.col("entered_at"), end))
    return timed.select(
        "*",
        F.when(F.col("exited_at").isNotNull(), "COMPLETED")
        .when(F.col("failed_at").isNotNull(), "FAILED")
        .otherwise("UNKNOWN")
        .alias("status"),
        F.coalesce(spent, F.lit("N/A")).alias("duration"),
    )


def run_listing(runs: DataFrame, now: str, clip_at: int = 100) -> DataFrame:
    """One line per run; an open run is measured up to ``now`` and long causes are cut."""
    stop = F.coalesce(F.col("stopped_at"), F.lit(now).cast("timestamp_ntz"))
    return runs.select(
        "run_id",
        "status",
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started"),
        text.duration_text(text.seconds_between(F.col("started_at"), stop)).alias("duration"),
        text.clip(F.col("cause"), clip_at).alias("cause"),
    )
