"""Counts, distributions, reshapes and profiles over all games."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.operators import month_profile, profile, stats
from touchline.plans.registry import day_sql, query
from touchline.plans.tables import contests, contests_sql, table
from touchline.sources.scratch import staged

_ALL = ("home_team", "away_team", "league", "venue")


@query("row_count", f"WITH {contests_sql()} SELECT count(*) AS games FROM contests")
def row_count(spark, sf_dir):
    return contests(spark, sf_dir).agg(F.count(F.lit(1)).alias("games"))


@query(
    "date_range",
    f"""WITH {contests_sql()}
    SELECT {day_sql("min(game_date)")} AS first_date, {day_sql("max(game_date)")} AS last_date FROM contests""",
)
def date_range(spark, sf_dir):
    return stats.date_range(contests(spark, sf_dir), "game_date")


_DISTINCT = ("league", "venue", "home_team", "away_team", "home_score")


@query(
    "distinct_counts",
    f"WITH {contests_sql(*_ALL)} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM contests" for c in _DISTINCT),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(contests(spark, sf_dir, *_ALL), list(_DISTINCT))


def _calendar(*parts: str) -> str:
    columns = ", ".join(f"CAST(extract({p} FROM game_date) AS BIGINT) AS {p}" for p in parts)
    places = ", ".join(str(i + 1) for i in range(len(parts)))
    return f"WITH {contests_sql()} SELECT {columns}, count(*) AS games FROM contests GROUP BY {places}"


@query("per_year", _calendar("year"))
def per_year(spark, sf_dir):
    return stats.count_by_calendar(contests(spark, sf_dir), "game_date", "year").orderBy("year")


@query("per_month", _calendar("year", "month"))
def per_month(spark, sf_dir):
    return stats.count_by_calendar(contests(spark, sf_dir), "game_date", "year", "month").orderBy("year", "month")


@query("per_day", _calendar("year", "month", "day"))
def per_day(spark, sf_dir):
    return stats.count_by_calendar(contests(spark, sf_dir), "game_date", "year", "month", "day")


_ROLLUP_SETS = "((league, year, month, day), (league, year, month), (league, year), (league), (year, month, day), (year, month), (year), ())"


@query(
    "calendar_rollup",
    f"""WITH {contests_sql('league')}, c AS (SELECT league, CAST(extract(year FROM game_date) AS BIGINT) AS year,
        CAST(extract(month FROM game_date) AS BIGINT) AS month, CAST(extract(day FROM game_date) AS BIGINT) AS day FROM contests)
    SELECT league, year, month, day, CAST(GROUPING(league, year, month, day) AS BIGINT) AS level, count(*) AS games
    FROM c GROUP BY GROUPING SETS {_ROLLUP_SETS}""",
)
def calendar_rollup(spark, sf_dir):
    return stats.calendar_rollup(contests(spark, sf_dir, "league"), "game_date", "league")


@query("by_league", f"WITH {contests_sql('league')} SELECT league, count(*) AS games FROM contests GROUP BY league")
def by_league(spark, sf_dir):
    return stats.count_by(contests(spark, sf_dir, "league"), "league").orderBy(F.desc("games"), "league")


@query(
    "by_status",
    f"WITH {contests_sql()} SELECT home_score, count(*) AS games FROM contests WHERE home_score IS NOT NULL GROUP BY 1",
)
def by_status(spark, sf_dir):
    counted = stats.count_by(contests(spark, sf_dir), "home_score", keep_null=False)
    return counted.orderBy(F.desc("games"), "home_score")


@query(
    "goals_summary",
    f"""WITH {contests_sql()}
    SELECT count(*) AS games, CAST(sum(home_score) + sum(away_score) AS BIGINT) AS total_goals,
           round((sum(home_score) + sum(away_score)) / count(*)::DOUBLE, 4) AS avg_goals FROM contests""",
)
def goals_summary(spark, sf_dir):
    return stats.goals_summary(contests(spark, sf_dir)).withColumn("avg_goals", F.round("avg_goals", 4))


@query(
    "outcome_summary",
    f"""WITH {contests_sql()}, counted AS (
        SELECT count(*) AS games, count(*) FILTER (home_score > away_score) AS home_wins,
               count(*) FILTER (home_score < away_score) AS away_wins,
               count(*) FILTER (home_score = away_score) AS draws FROM contests)
    SELECT *, round(home_wins * 100.0::DOUBLE / games, 2) AS home_wins_pct,
           round(away_wins * 100.0::DOUBLE / games, 2) AS away_wins_pct,
           round(draws * 100.0::DOUBLE / games, 2) AS draws_pct FROM counted""",
)
def outcome_summary(spark, sf_dir):
    return stats.outcome_summary(contests(spark, sf_dir))


@query(
    "avg_total_by_league",
    f"""WITH {contests_sql("league")}
    SELECT league, round(avg(home_score + away_score), 4) AS avg_total FROM contests GROUP BY league""",
)
def avg_total_by_league(spark, sf_dir):
    by_league = stats.average_total_by(contests(spark, sf_dir, "league"), "league")
    return by_league.withColumn("avg_total", F.round("avg_total", 4))


@query(
    "score_lines",
    f"""WITH {contests_sql()}, lines AS (
        SELECT coalesce(CAST(home_score AS VARCHAR), 'nan') || '-' || coalesce(CAST(away_score AS VARCHAR), 'nan')
               AS score_line, count(*) AS games FROM contests GROUP BY 1)
    SELECT score_line, games, round(games * 100.0::DOUBLE / (SELECT count(*) FROM contests), 2) AS pct
    FROM lines ORDER BY games DESC, score_line LIMIT 10""",
)
def score_lines(spark, sf_dir):
    return stats.score_lines(contests(spark, sf_dir), 10)


@query(
    "team_totals",
    f"""WITH {contests_sql("home_team", "away_team")},
    h AS (SELECT home_team AS team, count(*) AS n FROM contests GROUP BY 1),
    a AS (SELECT away_team AS team, count(*) AS n FROM contests GROUP BY 1)
    SELECT coalesce(h.team, a.team) AS team, coalesce(h.n, 0) AS home_games, coalesce(a.n, 0) AS away_games,
           coalesce(h.n, 0) + coalesce(a.n, 0) AS total_games
    FROM h FULL OUTER JOIN a ON h.team = a.team""",
)
def team_totals(spark, sf_dir):
    return stats.team_totals(contests(spark, sf_dir, "home_team", "away_team"))


@query(
    "top_teams",
    f"""WITH {contests_sql("home_team", "away_team")},
    seats AS (SELECT home_team AS team, 1 AS h FROM contests UNION ALL SELECT away_team, 0 FROM contests)
    SELECT team, CAST(sum(h) AS BIGINT) AS home_games, CAST(sum(1 - h) AS BIGINT) AS away_games,
           count(*) AS total_games FROM seats GROUP BY team ORDER BY total_games DESC, team LIMIT 10""",
)
def top_teams(spark, sf_dir):
    totals = stats.team_totals(contests(spark, sf_dir, "home_team", "away_team"))
    return totals.orderBy(F.desc("total_games"), "team").limit(10)


@query(
    "top_venues",
    f"""WITH {contests_sql("venue")}
    SELECT venue, count(*) AS games FROM contests WHERE venue IS NOT NULL GROUP BY venue
    ORDER BY games DESC, venue LIMIT 10""",
)
def top_venues(spark, sf_dir):
    return stats.top_by_count(contests(spark, sf_dir, "venue"), "venue")


@query(
    "unique_teams",
    f"""WITH {contests_sql("home_team", "away_team")}
    SELECT count(*) AS unique_teams
    FROM (SELECT home_team FROM contests UNION SELECT away_team FROM contests) t WHERE home_team IS NOT NULL""",
)
def unique_teams(spark, sf_dir):
    return stats.unique_sides(contests(spark, sf_dir, "home_team", "away_team"))


_PIVOT = f"""{contests_sql()}, pivoted AS (
    SELECT CAST(year(game_date) AS BIGINT) AS year,
           count(*) FILTER (home_score > away_score) AS home_win,
           count(*) FILTER (home_score < away_score) AS away_win,
           count(*) FILTER (home_score = away_score OR home_score IS NULL OR away_score IS NULL) AS draw
    FROM contests GROUP BY 1),
    pct AS (
    SELECT year, round(home_win * 100.0::DOUBLE / (home_win + away_win + draw), 4) AS home_win,
           round(away_win * 100.0::DOUBLE / (home_win + away_win + draw), 4) AS away_win,
           round(draw * 100.0::DOUBLE / (home_win + away_win + draw), 4) AS draw FROM pivoted)"""
_OUTCOMES = ["home_win", "away_win", "draw"]


def _pct(spark, sf_dir):
    shares = stats.row_percent(stats.outcome_pivot(contests(spark, sf_dir), "game_date"), "year", _OUTCOMES)
    return shares.select("year", *[F.round(c, 4).alias(c) for c in _OUTCOMES])


@query("outcome_pivot", f"WITH {_PIVOT} SELECT * FROM pivoted")
def outcome_pivot(spark, sf_dir):
    return stats.outcome_pivot(contests(spark, sf_dir), "game_date").orderBy("year")


@query("outcome_pct", f"WITH {_PIVOT} SELECT * FROM pct")
def outcome_pct(spark, sf_dir):
    return _pct(spark, sf_dir)


@query(
    "outcome_long",
    f"WITH {_PIVOT} "
    + " UNION ALL ".join(f"SELECT year, '{c}' AS result, {c} AS percentage FROM pct" for c in _OUTCOMES),
)
def outcome_long(spark, sf_dir):
    return stats.melt(_pct(spark, sf_dir), "year", _OUTCOMES, "result", "percentage")


@query(
    "score_matrix",
    f"""WITH {contests_sql()}
    SELECT home_score, away_score, count(*) AS games FROM contests
    WHERE home_score IS NOT NULL AND away_score IS NOT NULL GROUP BY 1, 2""",
)
def score_matrix(spark, sf_dir):
    return stats.score_matrix(contests(spark, sf_dir))


@query(
    "per_month_name",
    f"""WITH {contests_sql()}
    SELECT CAST(month(game_date) AS BIGINT) AS month, strftime(game_date, '%b') AS month_name, count(*) AS games
    FROM contests GROUP BY 1, 2""",
)
def per_month_name(spark, sf_dir):
    return stats.count_by_month_name(contests(spark, sf_dir), "game_date")


@query(
    "timeline",
    f"WITH {contests_sql()} SELECT {day_sql('game_date')} AS game_date, count(*) AS games FROM contests GROUP BY 1",
)
def timeline(spark, sf_dir):
    return stats.count_by(contests(spark, sf_dir), "game_date")


@query(
    "date_coverage",
    f"""WITH {contests_sql()}, days AS (SELECT game_date, count(*) AS n FROM contests GROUP BY 1)
    SELECT count(*) AS unique_dates, min(n) AS min_games, max(n) AS max_games FROM days""",
)
def date_coverage(spark, sf_dir):
    return stats.date_coverage(contests(spark, sf_dir), "game_date")


@query(
    "low_count_dates",
    f"""WITH {contests_sql()}
    SELECT {day_sql("game_date")} AS date, count(*) AS games FROM contests GROUP BY game_date HAVING count(*) < 20""",
)
def low_count_dates(spark, sf_dir):
    return stats.low_count_dates(contests(spark, sf_dir), "game_date", below=20)


# Every column of the view.
_TYPES = {
    "game_date": "date", "home_team": "string", "away_team": "string", "league": "string", "venue": "string",
    "home_score": "bigint", "away_score": "bigint", "l_orderkey": "bigint", "l_linenumber": "int",
}
_PROFILED = tuple(_TYPES)
_VIEW = ("home_team", "away_team", "league", "venue")
_PROFILE_SQL = contests_sql(*_VIEW)


def _missing_sql(extra: str = "", tail: str = "") -> str:
    return f"WITH {_PROFILE_SQL}, m AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\"{extra.replace('?', c)}, count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM contests"
        for c in _PROFILED
    ) + f") SELECT * FROM m{tail}"


@query("missing_by_column", _missing_sql())
def missing_by_column(spark, sf_dir):
    return profile.missing_by_column(contests(spark, sf_dir, *_VIEW))


@query("high_missing", _missing_sql(tail=" WHERE missing_pct > 10"))
def high_missing(spark, sf_dir):
    return profile.high_missing(contests(spark, sf_dir, *_VIEW), limit=10.0)


@query(
    "column_profile",
    f"WITH {_PROFILE_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(DISTINCT {c}) AS distinct_values, "
        f"count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct "
        "FROM contests"
        for c, t in _TYPES.items()
    ),
)
def column_profile(spark, sf_dir):
    return profile.column_profile(contests(spark, sf_dir, *_VIEW))


_MEASURED = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont({c}, 0.25), 4) AS p25, "
        f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75 FROM lineitem"
        for c in _MEASURED
    ),
)
def describe_numeric(spark, sf_dir):
    summary = profile.describe_numeric(table(spark, sf_dir, "lineitem"))
    return summary.select(
        "column", "count", "min", "max", *[F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    )


@query(
    "describe_text",
    "WITH t AS (SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
    "strftime(l_shipdate, '%Y-%m') AS month FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM t) AS count, (SELECT count(DISTINCT {c}) FROM t) AS \"unique\", "
        f"(SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        f"(SELECT count(*) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq"
        for c in ("l_returnflag", "l_linestatus", "l_linenumber", "month")
    ),
)
def describe_text(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return profile.describe_text(rows, ["l_returnflag", "l_linestatus", "l_linenumber", "month"])


_STATUS_SQL = """CASE WHEN l_linenumber % 3 = 0 THEN CAST(1 + l_orderkey % 12 AS VARCHAR) || ':' ||
        lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ' PM'
    WHEN l_linenumber % 3 = 1 THEN CAST(l_suppkey % 9 AS VARCHAR) || '-' || CAST(l_partkey % 7 AS VARCHAR)
    WHEN l_partkey % 5 > 0 THEN 'Postponed' END"""


@query(
    "regex_rates",
    f"""WITH s AS (SELECT {_STATUS_SQL} AS status FROM lineitem), c AS (
        SELECT count(*) AS n,
               count(*) FILTER (regexp_matches(status, '{fixed.TIME_LIKE}')) AS t,
               count(*) FILTER (regexp_matches(status, '{fixed.SCORE_LIKE}')) AS s FROM s)
    SELECT 'time' AS pattern, t AS matches, round(t * 100.0::DOUBLE / n, 2) AS pct FROM c
    UNION ALL SELECT 'score', s, round(s * 100.0::DOUBLE / n, 2) FROM c""",
)
def regex_rates(spark, sf_dir):
    line = F.col("l_linenumber") % 3
    clock = F.format_string("%d:%02d PM", 1 + F.col("l_orderkey") % 12, F.col("l_partkey") % 60)
    score = F.format_string("%d-%d", F.col("l_suppkey") % 9, F.col("l_partkey") % 7)
    status = F.when(line == 0, clock).when(line == 1, score).when(F.col("l_partkey") % 5 > 0, "Postponed")
    rows = table(spark, sf_dir, "lineitem").select(status.alias("status"))
    return profile.match_rates(rows, "status", {"time": fixed.TIME_LIKE, "score": fixed.SCORE_LIKE})


@query(
    "sorted_games",
    f"""WITH {contests_sql("league", "home_team")}
    SELECT {day_sql("game_date")} AS game_date, league, home_team, home_score, away_score, l_orderkey FROM contests""",
)
def sorted_games(spark, sf_dir):
    games = contests(spark, sf_dir, "league", "home_team")
    return games.select("game_date", "league", "home_team", "home_score", "away_score", "l_orderkey").orderBy(
        "game_date", "league", "home_team"
    )


@query(
    "project_sorted",
    f"""WITH {contests_sql("league", "home_team", "away_team", "venue")}
    SELECT league, home_team, away_team, home_score, away_score, venue FROM contests""",
)
def project_sorted(spark, sf_dir):
    games = contests(spark, sf_dir, *_ALL)
    return games.select("league", "home_team", "away_team", "home_score", "away_score", "venue").orderBy(
        "league", "home_team"
    )


@query(
    "filter_date",
    f"""WITH {contests_sql()}
    SELECT {day_sql("game_date")} AS game_date, home_score, away_score, l_orderkey, l_linenumber
    FROM contests WHERE game_date = DATE '1997-03-15'""",
)
def filter_date(spark, sf_dir):
    return contests(stats.on_dates(table(spark, sf_dir, "lineitem"), "l_shipdate", "1997-03-15"), sf_dir)


@query(
    "filter_date_prefix",
    f"""WITH {contests_sql()}
    SELECT {day_sql("game_date")} AS game_date, home_score, away_score, l_orderkey, l_linenumber
    FROM contests WHERE {day_sql("game_date")} LIKE '1997-03%'""",
)
def filter_date_prefix(spark, sf_dir):
    return contests(stats.in_period(table(spark, sf_dir, "lineitem"), "l_shipdate", "1997-03"), sf_dir)


@query(
    "filter_score_gt",
    f"""WITH {contests_sql()}
    SELECT {day_sql("game_date")} AS game_date, home_score, away_score, l_orderkey, l_linenumber
    FROM contests WHERE home_score > 5
    ORDER BY contests.game_date, l_orderkey, l_linenumber, home_score, away_score LIMIT 5""",
)
def filter_score_gt(spark, sf_dir):
    games = contests(spark, sf_dir).where(F.col("home_score") > 5)
    return games.orderBy("game_date", "l_orderkey", "l_linenumber", "home_score", "away_score").limit(5)


_MONTH_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
_MONTH_TEXT = ("l_returnflag", "l_linestatus")
_NO_TEXT = "NULL::BIGINT AS \"unique\", NULL::VARCHAR AS top, NULL::BIGINT AS freq"
_NO_NUMBERS = ", ".join(f"NULL::DOUBLE AS {c}" for c in ("mean", "std", "min", "max"))


@query(
    "profile_months",
    " UNION ALL ".join(
        [
            f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, count({c}) AS count, "
            f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
            f"CAST(max({c}) AS DOUBLE) AS max, {_NO_TEXT} FROM lineitem"
            for c in _MONTH_NUMERIC
        ]
        + [
            f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, count({c}) AS count, {_NO_NUMBERS}, "
            f"count(DISTINCT {c}) AS \"unique\", "
            f"(SELECT {c} FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
            f"(SELECT count(*) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM lineitem"
            for c in _MONTH_TEXT
        ]
    ),
)
def profile_months(spark, sf_dir):
    """Profiles of lineitem merged from stored partials per shipping month, all rows read."""
    lines = table(spark, sf_dir, "lineitem")
    month = F.date_format("l_shipdate", "yyyy-MM")
    moments, values = month_profile.month_partials(lines, month, list(_MONTH_NUMERIC), list(_MONTH_TEXT))
    merged = month_profile.merge(staged(moments, "moments"), staged(values, "values"))
    return merged.select(
        "column", "rows", "missing", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min", "max", "unique", "top", "freq"
    )
