"""Checks on parsed games, per row, day and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed


def required_errors() -> list[Column]:
    """One message per required field that is null or empty."""
    return [
        F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(fixed.MISSING_FIELD + name))
        for name in fixed.REQUIRED_FIELDS
    ]


def date_error(date: str = "date") -> Column:
    """Set when the text is not year-month-day; unpadded parts are fine."""
    good = F.col(date).rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_date(date, "yyyy-M-d").isNotNull()
    return F.when(~F.coalesce(good, F.lit(False)), F.lit(fixed.BAD_DATE))


def same_side_error(home: str = "home_team", away: str = "away_team") -> Column:
    """Set when both sides are equal; two nulls count as equal."""
    return F.when(F.col(home).eqNullSafe(F.col(away)), F.lit(fixed.SAME_TEAM))


def field_error(field: str = "field") -> Column:
    """Set when a place is given and does not start with the expected word."""
    bad = (F.col(field) != "") & ~F.startswith(F.col(field), F.lit(fixed.FIELD_PREFIX))
    return F.when(bad, F.lit(fixed.BAD_FIELD))


def game_errors() -> Column:
    """All messages of one game, in check order; empty when it is valid."""
    checks = [*required_errors(), date_error(), same_side_error(), field_error()]
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def with_errors(games: DataFrame) -> DataFrame:
    """Games with their ``errors`` array."""
    return games.withColumn("errors", game_errors())


GAME_JSON = (
    "array<struct<date:string, league_name:string, home_team:string, away_team:string, field:string, time:string>>"
)


def games_of_day_files(files: DataFrame, date: str = "date", content: str = "content") -> DataFrame:
    """Games of stored day files with their position in the file.

    A file that is not JSON keeps one row with status ``invalid_json`` and a
    date without file one with ``missing``; an empty file keeps one as well.
    """
    parsed = F.from_json(F.col(content), GAME_JSON)
    status = (
        F.when(F.col(content).isNull(), "missing")
        .when(F.try_parse_json(content).isNull(), "invalid_json")
        .otherwise("validated")
    )
    others = [F.col(c) for c in files.columns if c not in (date, content)]
    rows = files.select(
        *others, F.col(date).alias("file_date"), status.alias("status"), F.posexplode_outer(parsed).alias("pos", "game")
    )
    kept = [c for c in files.columns if c not in (date, content)]
    return rows.select(*kept, "file_date", "status", F.col("pos").cast("bigint").alias("game_index"), "game.*")


def day_report(games: DataFrame) -> DataFrame:
    """Games, valid games and state per day, from :func:`games_of_day_files`."""
    is_game = F.col("game_index").isNotNull() & (F.col("status") == "validated")
    valid = is_game & (F.size(game_errors()) == 0)
    return games.groupBy("file_date").agg(
        F.min("status").alias("status"),
        F.count_if(is_game).alias("games_count"),
        F.count_if(valid).alias("valid_games_count"),
    )


def expected_days(days: DataFrame, report: DataFrame) -> DataFrame:
    """The day report over all expected days; days without a file are ``missing``."""
    return days.join(report, "file_date", "left").select(
        "file_date",
        F.coalesce("status", F.lit("missing")).alias("status"),
        F.coalesce("games_count", F.lit(0)).alias("games_count"),
        F.coalesce("valid_games_count", F.lit(0)).alias("valid_games_count"),
    )


def split_valid(games: DataFrame) -> DataFrame:
    """Games of :func:`games_of_day_files` that can be read, with their ``errors`` and whether they are ``valid``."""
    read = with_errors(games.where(F.col("game_index").isNotNull() & (F.col("status") == "validated")))
    return read.withColumn("valid", F.size("errors") == 0)


def month_report(days: DataFrame) -> DataFrame:
    """Totals per month, the number of days whose file has any error, and that of days without a file."""
    missing = F.col("status") == "missing"
    faulty = ~missing & ((F.col("status") != "validated") | (F.col("valid_games_count") < F.col("games_count")))
    return days.groupBy(F.date_format("file_date", "yyyy-MM").alias("month")).agg(
        F.sum("games_count").alias("total_games"),
        F.sum("valid_games_count").alias("total_valid_games"),
        F.count_if(faulty).alias("days_with_errors"),
        F.count_if(missing).alias("days_missing"),
    )
