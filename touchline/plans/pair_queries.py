"""Queries on one entity's games."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import pairs, patterns
from touchline.plans.registry import day_sql, query
from touchline.plans.tables import ENTITY, contests, contests_sql, entity_sql, table

_SIDES = ("home_team", "away_team")
_RESULTS = """count(*) AS games,
    CAST(sum(CASE WHEN score > opp_score THEN 1 ELSE 0 END) AS BIGINT) AS wins,
    CAST(sum(CASE WHEN score < opp_score THEN 1 ELSE 0 END) AS BIGINT) AS losses,
    CAST(sum(CASE WHEN score = opp_score THEN 1 ELSE 0 END) AS BIGINT) AS draws,
    round(avg(score), 2) + 0.0 AS avg_for, round(avg(opp_score), 2) + 0.0 AS avg_against"""
_TIEBREAK = ("game_date", "entity", "opponent", "score", "l_orderkey", "l_linenumber")


def _view(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    attributes = [k for k in keep if k in ("league", "venue")]
    return pairs.entity_view(contests(spark, sf_dir, *_SIDES, *attributes), ENTITY, keep)


@query(
    "entity_games",
    f"""WITH {entity_sql("league")}
    SELECT {day_sql("game_date")} AS game_date, entity, opponent, score, opp_score, side, league,
           l_orderkey, l_linenumber
    FROM view""",
)
def entity_games(spark, sf_dir):
    return _view(spark, sf_dir, "game_date", "league", "l_orderkey", "l_linenumber").orderBy("game_date")


@query("name_variations", f"WITH {entity_sql()} SELECT DISTINCT entity FROM view")
def name_variations(spark, sf_dir):
    return pairs.name_variations(contests(spark, sf_dir, *_SIDES), ENTITY)


@query(
    "entity_record",
    f"WITH {entity_sql()} SELECT {_RESULTS}, round(avg(score - opp_score), 2) + 0.0 AS avg_margin FROM view",
)
def entity_record(spark, sf_dir):
    return pairs.entity_record(_view(spark, sf_dir))


@query("record_by_side", f"WITH {entity_sql()} SELECT side, {_RESULTS} FROM view GROUP BY side")
def record_by_side(spark, sf_dir):
    return pairs.record_by(_view(spark, sf_dir), "side")


@query(
    "record_by_opponent",
    f"WITH {entity_sql()} SELECT opponent, {_RESULTS} FROM view GROUP BY opponent HAVING count(*) >= 2",
)
def record_by_opponent(spark, sf_dir):
    return pairs.record_by(_view(spark, sf_dir), "opponent", at_least=2)


@query(
    "entity_leagues",
    f"WITH {entity_sql('league')} SELECT league, count(*) AS games FROM view GROUP BY league",
)
def entity_leagues(spark, sf_dir):
    games = pairs.either_side_like(contests(spark, sf_dir, *_SIDES, "league"), ENTITY)
    return games.groupBy("league").agg(F.count(F.lit(1)).alias("games")).orderBy(F.desc("games"), "league")


def _margin_sql(margin: str) -> str:
    return f"""WITH {entity_sql("league")}
    SELECT {day_sql("game_date")} AS game_date, entity, opponent, score, opp_score, side, league,
           l_orderkey, l_linenumber, {margin} AS margin
    FROM view WHERE {margin} > 0
    ORDER BY {margin} DESC, view.game_date, entity, opponent, score, l_orderkey, l_linenumber LIMIT 5"""


@query("biggest_wins", _margin_sql("score - opp_score"))
def biggest_wins(spark, sf_dir):
    view = _view(spark, sf_dir, "game_date", "league", "l_orderkey", "l_linenumber")
    return pairs.widest_margins(view, won=True, k=5, tiebreak=_TIEBREAK)


@query("biggest_losses", _margin_sql("opp_score - score"))
def biggest_losses(spark, sf_dir):
    view = _view(spark, sf_dir, "game_date", "league", "l_orderkey", "l_linenumber")
    return pairs.widest_margins(view, won=False, k=5, tiebreak=_TIEBREAK)


@query(
    "recent_games",
    f"""WITH {entity_sql()}
    SELECT {day_sql("game_date")} AS game_date, entity, opponent, score, opp_score, side, l_orderkey, l_linenumber
    FROM view
    ORDER BY view.game_date DESC, l_orderkey DESC, l_linenumber DESC, entity DESC, opponent DESC,
             score DESC NULLS LAST, opp_score DESC NULLS LAST LIMIT 5""",
)
def recent_games(spark, sf_dir):
    view = _view(spark, sf_dir, "game_date", "l_orderkey", "l_linenumber")
    newest = [F.col(c).desc_nulls_last() for c in ("game_date", "l_orderkey", "l_linenumber", "entity", "opponent")]
    return view.orderBy(*newest, F.desc_nulls_last("score"), F.desc_nulls_last("opp_score")).limit(5)


@query(
    "filter_either_like",
    f"""WITH {contests_sql(*_SIDES)}
    SELECT {day_sql("game_date")} AS game_date, home_team, away_team, home_score, away_score, l_orderkey, l_linenumber
    FROM contests WHERE home_team LIKE '{ENTITY}' OR away_team LIKE '{ENTITY}'""",
)
def filter_either_like(spark, sf_dir):
    return pairs.either_side_like(contests(spark, sf_dir, *_SIDES), ENTITY)


@query(
    "outcome_class",
    f"""WITH {contests_sql()}
    SELECT l_orderkey, l_linenumber, home_score, away_score,
           CASE WHEN home_score > away_score THEN 'Home Win' WHEN home_score < away_score THEN 'Away Win'
                ELSE 'Draw' END AS result
    FROM contests""",
)
def outcome_class(spark, sf_dir):
    games = contests(spark, sf_dir)
    return games.select("l_orderkey", "l_linenumber", "home_score", "away_score", pairs.outcome().alias("result"))


@query(
    "result_label",
    f"""WITH {contests_sql("league")}
    SELECT l_orderkey, l_linenumber,
           CASE WHEN home_score IS NOT NULL AND away_score IS NOT NULL
                THEN 'Score: ' || CAST(home_score AS VARCHAR) || '-' || CAST(away_score AS VARCHAR)
                ELSE 'Status: ' || league END AS label
    FROM contests""",
)
def result_label(spark, sf_dir):
    games = contests(spark, sf_dir, "league")
    return games.select("l_orderkey", "l_linenumber", pairs.result_label(status="league").alias("label"))


_MATCH_SIDES = {
    "entity_team": ("home_team", "away_team"), "opponent": ("away_team", "home_team"),
    "entity_score": ("home_score", "away_score"), "opponent_score": ("away_score", "home_score"),
}


@query(
    "entity_matches",
    f"""WITH {contests_sql("home_team", "away_team", "league")},
    pats AS (SELECT DISTINCT unnest(string_split(n_name, ' ')) AS pattern FROM nation),
    m AS (SELECT p.pattern, c.*, coalesce(contains(c.home_team, p.pattern), false) AS at_home FROM contests c JOIN pats p
          ON contains(c.home_team, p.pattern) OR contains(c.away_team, p.pattern) WHERE p.pattern <> '')
    SELECT pattern, l_orderkey, l_linenumber, {day_sql("game_date")} AS game_date,
           {", ".join(f"CASE WHEN at_home THEN {h} ELSE {a} END AS {n}" for n, (h, a) in _MATCH_SIDES.items())},
           league, CASE WHEN at_home THEN 'home' ELSE 'away' END AS venue FROM m""",
)
def entity_matches(spark, sf_dir):
    """Every game of every team whose name holds a word of a nation's name, matched through an n-gram index."""
    games = contests(spark, sf_dir, "home_team", "away_team", "league")
    names = games.select(F.col("home_team").alias("name")).union(games.select(F.col("away_team").alias("name"))).distinct()
    words = table(spark, sf_dir, "nation").select(F.explode(F.split("n_name", " ")).alias("pattern")).distinct()
    found = patterns.matches(names, "name", "name", words, "pattern", "pattern")
    home = games.join(found.withColumnRenamed("name", "home_team"), "home_team").withColumn("at_home", F.lit(True))
    away = games.join(found.withColumnRenamed("name", "away_team"), "away_team")
    away = away.join(found.select(F.col("name").alias("home_team"), "pattern"), ["home_team", "pattern"], "left_anti")
    both = home.unionByName(away.withColumn("at_home", F.lit(False)))
    sides = [F.when(F.col("at_home"), F.col(h)).otherwise(F.col(a)).alias(n) for n, (h, a) in _MATCH_SIDES.items()]
    venue = F.when(F.col("at_home"), F.lit("home")).otherwise(F.lit("away")).alias("venue")
    return both.select("pattern", "l_orderkey", "l_linenumber", "game_date", *sides, "league", venue)
