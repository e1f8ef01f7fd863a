"""Counts and summaries over a two-sided table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.operators.pairs import CANONICAL_SIDES, Sides, outcome


def count_by(df: DataFrame, *keys: Column | str, keep_null: bool = True, name: str = "games") -> DataFrame:
    """Group count. ``keep_null=False`` leaves out rows with a null key."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    if not keep_null:
        for column in columns:
            df = df.where(column.isNotNull())
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def count_by_calendar(df: DataFrame, date: str, *parts: str, name: str = "games") -> DataFrame:
    """Group count per ``year``, ``month``, ``day`` or any mix of them."""
    return count_by(df, *[F.extract(F.lit(p), F.col(date)).cast("bigint").alias(p) for p in parts], name=name)


def calendar_rollup(df: DataFrame, date: str, key: str, name: str = "games") -> DataFrame:
    """Counts per day, month, year and in all, each with and without ``key``, from one scan.

    Grouping sets; ``level`` is the grouping id over (key, year, month, day):
    a bit is set for each column summed over, so a null key or day of the
    data is told apart from a subtotal.
    """
    parts = [F.extract(F.lit(p), F.col(date)).cast("bigint").alias(p) for p in ("year", "month", "day")]
    rows = df.select(F.col(key), *parts)
    chains = [["year", "month", "day"], ["year", "month"], ["year"], []]
    sets = [[key, *c] for c in chains] + chains
    counted = rows.groupingSets(sets, key, "year", "month", "day").agg(
        F.grouping_id(key, "year", "month", "day").cast("bigint").alias("level"), F.count(F.lit(1)).alias(name)
    )
    return counted


def count_by_month_name(df: DataFrame, date: str) -> DataFrame:
    """Count per calendar month over all years, in calendar order."""
    counted = count_by(df, F.month(date).alias("month"))
    named = F.element_at(F.array(*[F.lit(m) for m in fixed.MONTHS]), F.col("month"))
    return counted.select(F.col("month").cast("bigint").alias("month"), named.alias("month_name"), "games").orderBy(
        "month"
    )


def date_range(df: DataFrame, date: str) -> DataFrame:
    """First and last date in one row."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def top_by_count(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent values; equal counts fall back to the value."""
    return count_by(df, key, keep_null=False).orderBy(F.desc("games"), key).limit(k)


def team_totals(df: DataFrame, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Home, away and all games per side, zero where a side never appears.

    Each row is read once and emits its two sides, so one scan and one
    pre-aggregated shuffle replace two counts and a full outer join.
    """
    seats = F.explode(
        F.array(
            F.struct(F.col(sides.home).alias("team"), F.lit(True).alias("at_home")),
            F.struct(F.col(sides.away).alias("team"), F.lit(False).alias("at_home")),
        )
    )
    return (
        df.select(seats.alias("seat"))
        .select("seat.*")
        .where(F.col("team").isNotNull())
        .groupBy("team")
        .agg(
            F.count_if("at_home").alias("home_games"),
            F.count_if(~F.col("at_home")).alias("away_games"),
            F.count(F.lit(1)).alias("total_games"),
        )
    )


def unique_sides(df: DataFrame, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Number of distinct names over both sides, from one scan."""
    names = df.select(F.explode(F.array(sides.home, sides.away)).alias("team"))
    return names.where(F.col("team").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("unique_teams"))


def goals_summary(df: DataFrame, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """All goals and goals per game; games without scores stay in the denominator."""
    goals = F.coalesce(F.sum(sides.home_score), F.lit(0)) + F.coalesce(F.sum(sides.away_score), F.lit(0))
    games = F.count(F.lit(1))
    return df.agg(games.alias("games"), goals.alias("total_goals")).withColumn(
        "avg_goals", F.try_divide(F.col("total_goals"), F.col("games"))
    )


def outcome_summary(df: DataFrame, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Home wins, away wins and draws with their share of all rows."""
    home, away = F.col(sides.home_score), F.col(sides.away_score)
    counted = df.agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(home > away).alias("home_wins"),
        F.count_if(home < away).alias("away_wins"),
        F.count_if(home == away).alias("draws"),
    )
    for name in ("home_wins", "away_wins", "draws"):
        share = F.round(F.try_divide(F.col(name) * 100.0, F.col("games")), 2)
        counted = counted.withColumn(f"{name}_pct", share)
    return counted


def average_total_by(df: DataFrame, key: str, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Mean of both scores together per key, highest first."""
    total = F.avg(F.col(sides.home_score) + F.col(sides.away_score)).alias("avg_total")
    return df.groupBy(key).agg(total).orderBy(F.desc("avg_total"), key)


def score_lines(df: DataFrame, k: int = 10, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Most frequent score lines with their share of all rows; unknown scores print ``nan``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))
    line = F.concat(part(sides.home_score), F.lit("-"), part(sides.away_score))
    counted = count_by(df, line.alias("score_line"))
    total = counted.agg(F.sum("games").alias("n")).scalar()
    return (
        counted.orderBy(F.desc("games"), "score_line")
        .limit(k)
        .withColumn("pct", F.round(F.col("games") * 100.0 / total, 2))
    )


def score_matrix(df: DataFrame, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Count per pair of scores, rows with an unknown score left out."""
    return count_by(df, sides.home_score, sides.away_score, keep_null=False)


def outcome_pivot(df: DataFrame, date: str, sides: Sides = CANONICAL_SIDES) -> DataFrame:
    """Outcome counts per year, one column per outcome.

    Conditional counts give the pivot in a single shuffle.
    """
    label = outcome(sides)
    return df.groupBy(F.year(date).cast("bigint").alias("year")).agg(
        F.count_if(label == fixed.HOME_WIN).alias("home_win"),
        F.count_if(label == fixed.AWAY_WIN).alias("away_win"),
        F.count_if(label == fixed.DRAW).alias("draw"),
    )


def row_percent(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each column as a percentage of its row's sum."""
    whole = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.select(key, *[F.try_divide(F.col(c) * 100.0, whole).alias(c) for c in columns])


def melt(df: DataFrame, key: str, columns: list[str], name: str, value: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot([key], columns, name, value)


def date_coverage(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates and the smallest and largest day."""
    return count_by(df, F.to_date(date).alias("date")).agg(
        F.count(F.lit(1)).alias("unique_dates"),
        F.min("games").alias("min_games"),
        F.max("games").alias("max_games"),
    )


def low_count_dates(df: DataFrame, date: str, below: int = 5) -> DataFrame:
    """Dates with fewer rows than ``below``."""
    return count_by(df, F.to_date(date).alias("date")).where(F.col("games") < below)


def on_dates(df: DataFrame, date: str, first: str, last: str | None = None) -> DataFrame:
    """Rows from ``first`` to ``last``, whole days, as a range on the stored stamp.

    A range on the bare column is pushed to the scan; a cast of it is not.
    """
    low = F.lit(first).cast("date").cast("timestamp_ntz")
    high = F.date_add(F.lit(last or first).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(date) >= low) & (F.col(date) < high))


def in_period(df: DataFrame, date: str, prefix: str) -> DataFrame:
    """Rows whose date starts with ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd``."""
    first = f"{prefix}-01-01"[:10] if len(prefix) == 4 else f"{prefix}-01"[:10]
    day = F.lit(first).cast("date")
    step = {4: F.make_ym_interval(F.lit(1)), 7: F.make_ym_interval(F.lit(0), F.lit(1))}
    end = F.date_add(day, 1) if len(prefix) == 10 else (day + step[len(prefix)]).cast("date")
    return df.where((F.col(date) >= day.cast("timestamp_ntz")) & (F.col(date) < end.cast("timestamp_ntz")))
