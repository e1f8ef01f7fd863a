"""Two-sided rows seen from one side, and records built on that view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed


@dataclass(frozen=True)
class Sides:
    """Names of the two sides and their scores."""

    home: str = "home_team"
    away: str = "away_team"
    home_score: str = "home_score"
    away_score: str = "away_score"


CANONICAL_SIDES = Sides()


def either_side_like(games: DataFrame, pattern: str, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Rows in which one side or the other matches the LIKE pattern."""
    return games.where(F.col(sides.home).like(pattern) | F.col(sides.away).like(pattern))


def entity_view(
    games: DataFrame, pattern: str, keep: tuple[str, ...] = (), sides: Sides = CANONICAL_SIDES
) -> DataFrame:
    """One row per game of the matching entity, from its own perspective.

    When both sides match, the home side is taken. Narrow: no shuffle.
    """
    at_home = F.col(sides.home).like(pattern)

    def own(home: str, away: str) -> Column:
        return F.when(at_home, F.col(home)).otherwise(F.col(away))

    return either_side_like(games, pattern, sides).select(
        *keep,
        own(sides.home, sides.away).alias("entity"),
        own(sides.away, sides.home).alias("opponent"),
        own(sides.home_score, sides.away_score).alias("score"),
        own(sides.away_score, sides.home_score).alias("opp_score"),
        F.when(at_home, F.lit("home")).otherwise(F.lit("away")).alias("side"),
    )


def name_variations(games: DataFrame, pattern: str, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Distinct names under which the entity appears."""
    return entity_view(games, pattern, sides=sides).select("entity").distinct()


def _results() -> list[Column]:
    ahead, behind, level = (
        F.col("score") > F.col("opp_score"),
        F.col("score") < F.col("opp_score"),
        F.col("score") == F.col("opp_score"),
    )
    return [
        F.count(F.lit(1)).alias("games"),
        F.count_if(ahead).alias("wins"),
        F.count_if(behind).alias("losses"),
        F.count_if(level).alias("draws"),
        F.round(F.avg("score"), 2).alias("avg_for"),
        F.round(F.avg("opp_score"), 2).alias("avg_against"),
    ]


def entity_record(view: DataFrame) -> DataFrame:
    """Games, wins, losses, draws and averages over an entity view."""
    margin = F.round(F.avg(F.col("score") - F.col("opp_score")), 2).alias("avg_margin")
    return view.agg(*_results(), margin)


def record_by(view: DataFrame, *keys: str, at_least: int = 1) -> DataFrame:
    """The record split by key columns, most games first."""
    split = view.groupBy(*keys).agg(*_results())
    if at_least > 1:
        split = split.where(F.col("games") >= at_least)
    return split.orderBy(F.desc("games"), F.desc("wins"), *keys)


def widest_margins(view: DataFrame, won: bool, k: int, tiebreak: tuple[str, ...]) -> DataFrame:
    """The k clearest wins or defeats. Ties are settled by ``tiebreak``."""
    margin = F.col("score") - F.col("opp_score")
    margin = margin if won else -margin
    return (
        view.withColumn("margin", margin)
        .where(F.col("margin") > 0)
        .orderBy(F.desc("margin"), *tiebreak)
        .limit(k)
    )


def outcome(sides: Sides = CANONICAL_SIDES) -> Column:
    """Outcome label. A row without both scores counts as a draw."""
    home, away = F.col(sides.home_score), F.col(sides.away_score)
    return (
        F.when(home > away, F.lit(fixed.HOME_WIN)).when(home < away, F.lit(fixed.AWAY_WIN)).otherwise(F.lit(fixed.DRAW))
    )


def result_label(sides: Sides = CANONICAL_SIDES, status: str = "status") -> Column:
    """``Score: a-b`` when both scores are known, else ``Status: …``."""
    home, away = F.col(sides.home_score), F.col(sides.away_score)
    known = home.isNotNull() & away.isNotNull()
    scored = F.concat(F.lit("Score: "), home.cast("string"), F.lit("-"), away.cast("string"))
    return F.when(known, scored).otherwise(F.concat(F.lit("Status: "), F.coalesce(F.col(status), F.lit("nan"))))
