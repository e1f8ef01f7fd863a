"""Queries on raw records and day files."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import text
from touchline.operators import ingest, merge
from touchline.plans import feeds
from touchline.plans.feeds import DATE_SQL, FILE_GAMES_SQL, FILES_SQL, GAMES_SQL, RECORDS_SQL, STAMP_SQL, trim_sql
from touchline.plans.registry import query, stamp_sql
from touchline.plans.tables import RUN_TS, YEAR, table

_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")
_KEYS_SQL = "l_orderkey, l_linenumber, l_partkey"


def _cleaned(spark, sf_dir):
    return ingest.ingest(feeds.records(spark, sf_dir), RUN_TS, YEAR)


@query(
    "shape_router",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN broken THEN 'unparsable' WHEN shape = 'flat' THEN 'flat' ELSE 'nested' END AS shape
    FROM feed""",
)
def shape_router(spark, sf_dir):
    parsed = ingest.parse_records(feeds.records(spark, sf_dir))
    return parsed.select(*_KEYS, "shape")


@query(
    "alt_to_canonical",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, league, game_day AS date, '10:00 AM' AS time, home_team, away_team, 'regular' AS type, url, status
    FROM feed WHERE shape = 'flat' AND NOT broken""",
)
def alt_to_canonical(spark, sf_dir):
    games = ingest.explode_games(ingest.parse_records(feeds.records(spark, sf_dir)))
    names = ("league", "date", "time", "home_team", "away_team", "type", "url", "status")
    return games.where(F.col("shape") == "flat").select(*_KEYS, *[f"game.{n}" for n in names])


@query(
    "explode_games",
    f"""WITH {GAMES_SQL}
    SELECT {_KEYS_SQL}, game_day AS date, home_team, away_team, hs AS home_score, aws AS away_score, bad_score
    FROM games WHERE shape = 'nested'""",
)
def explode_games(spark, sf_dir):
    games = ingest.explode_games(ingest.parse_records(feeds.records(spark, sf_dir)))
    names = ("date", "home_team", "away_team", "home_score", "away_score", "bad_score")
    return games.where(F.col("shape") == "nested").select(*_KEYS, *[f"game.{n}" for n in names])


@query(
    "score_split",
    f"""WITH {RECORDS_SQL}, parts AS (SELECT *, string_split(score, ' - ') AS p FROM feed), n AS (
        SELECT {_KEYS_SQL}, score, CASE WHEN len(p) = 2 THEN TRY_CAST(p[1] AS BIGINT) END AS home_score,
               CASE WHEN len(p) = 2 THEN TRY_CAST(p[2] AS BIGINT) END AS right_score FROM parts)
    SELECT {_KEYS_SQL}, score, home_score, CASE WHEN home_score IS NOT NULL THEN right_score END AS away_score FROM n""",
)
def score_split(spark, sf_dir):
    home, away = text.score_parts(F.col("score"))
    fields = feeds.record_fields(spark, sf_dir)
    return fields.select(*_KEYS, "score", home.alias("home_score"), away.alias("away_score"))


@query(
    "required_strings",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, {trim_sql("home_team")} AS home_team, {trim_sql("away_team")} AS away_team,
           {trim_sql("league")} AS league
    FROM feed WHERE coalesce({trim_sql("home_team")}, '') <> '' AND coalesce({trim_sql("away_team")}, '') <> ''
      AND coalesce({trim_sql("league")}, '') <> ''""",
)
def required_strings(spark, sf_dir):
    names = ("home_team", "away_team", "league")
    fields = feeds.record_fields(spark, sf_dir)
    for name in names:
        fields = fields.where(~text.is_blank(F.col(name)))
    return fields.select(*_KEYS, *[text.strip_text(F.col(n)).alias(n) for n in names])


@query(
    "nonneg_scores",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, TRY_CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score
    FROM feed WHERE home_score IS NULL OR coalesce(TRY_CAST(home_score AS BIGINT), -1) >= 0""",
)
def nonneg_scores(spark, sf_dir):
    home = text.coerce_long(F.col("home_score"))
    fine = F.col("home_score").isNull() | F.coalesce(home >= 0, F.lit(False))
    fields = feeds.record_fields(spark, sf_dir).where(fine)
    return fields.select(*_KEYS, home.alias("home_score"), text.coerce_long(F.col("away_score")).alias("away_score"))


@query(
    "url_rule",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, url FROM feed WHERE url IS NULL OR url LIKE 'http://%' OR url LIKE 'https://%'""",
)
def url_rule(spark, sf_dir):
    return feeds.record_fields(spark, sf_dir).where(text.web_address_ok(F.col("url"))).select(*_KEYS, "url")


@query(
    "status_range",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, TRY_CAST(status AS DOUBLE) AS status
    FROM feed WHERE status IS NULL OR TRY_CAST(status AS DOUBLE) BETWEEN 0 AND 1""",
)
def status_range(spark, sf_dir):
    status = text.coerce_double(F.col("status"))
    fine = F.col("status").isNull() | status.between(0, 1)
    return feeds.record_fields(spark, sf_dir).where(fine).select(*_KEYS, status.alias("status"))


@query(
    "date_parse",
    f"WITH {RECORDS_SQL} SELECT {_KEYS_SQL}, game_day, {stamp_sql(DATE_SQL)} AS date FROM feed",
)
def date_parse(spark, sf_dir):
    return feeds.record_fields(spark, sf_dir).select(
        *_KEYS, "game_day", text.game_date(F.col("game_day"), YEAR).alias("date")
    )


@query(
    "ts_parse",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, stamp, {stamp_sql(f"coalesce({STAMP_SQL}, TIMESTAMP '{RUN_TS}')")} AS timestamp
    FROM feed WHERE stamp IS NULL OR stamp <> 'never'""",
)
def ts_parse(spark, sf_dir):
    parsed = text.utc_stamp(F.col("stamp"))
    fields = feeds.record_fields(spark, sf_dir).where(F.col("stamp").isNull() | parsed.isNotNull())
    return fields.select(*_KEYS, "stamp", F.coalesce(parsed, F.lit(RUN_TS).cast("timestamp_ntz")).alias("timestamp"))


_RULES = [
    ("date", f"({DATE_SQL}) IS NULL"),
    ("home_team", f"coalesce({trim_sql('home_team')}, '') = ''"),
    ("away_team", f"coalesce({trim_sql('away_team')}, '') = ''"),
    ("league", f"coalesce({trim_sql('league')}, '') = ''"),
    ("score", "bad_score OR coalesce(hs < 0, FALSE) OR coalesce(aws < 0, FALSE)"),
    ("url", "NOT (url IS NULL OR url LIKE 'http://%' OR url LIKE 'https://%')"),
    ("status", "status IS NOT NULL AND NOT coalesce(TRY_CAST(status AS DOUBLE) BETWEEN 0 AND 1, FALSE)"),
    ("timestamp", f"stamp IS NOT NULL AND ({STAMP_SQL}) IS NULL"),
]
_CHECKED = f"""{GAMES_SQL}, checked AS (
    SELECT *, array_to_string(list_filter([{", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _RULES)}],
                              lambda e: e IS NOT NULL), '|') AS errors FROM games)"""


VALID_GAMES_SQL = f"""{_CHECKED}, valid AS (
    SELECT {stamp_sql(DATE_SQL)} AS date, {trim_sql("home_team")} AS home_team, {trim_sql("away_team")} AS away_team,
           hs AS home_score, aws AS away_score, {trim_sql("league")} AS league, time, url, type,
           TRY_CAST(status AS DOUBLE) AS status, CAST(NULL AS VARCHAR) AS headers,
           {stamp_sql(f"coalesce({STAMP_SQL}, TIMESTAMP '{RUN_TS}')")} AS timestamp
    FROM checked WHERE errors = '')"""


REJECTED_GAMES_SQL = f"""{_CHECKED}, rejected AS (
    SELECT errors FROM checked WHERE errors <> '' UNION ALL SELECT 'record' FROM feed WHERE broken)"""


@query("valid_rows", f"WITH {VALID_GAMES_SQL} SELECT * FROM valid")
def valid_rows(spark, sf_dir):
    return ingest.valid_rows(_cleaned(spark, sf_dir))


@query(
    "quarantine_rows",
    f"""WITH {_CHECKED}
    SELECT {_KEYS_SQL}, shape, errors FROM checked WHERE errors <> ''
    UNION ALL SELECT {_KEYS_SQL}, 'unparsable', 'record' FROM feed WHERE broken""",
)
def quarantine_rows(spark, sf_dir):
    return ingest.quarantine_rows(_cleaned(spark, sf_dir)).select(*_KEYS, "shape", "errors")


_MIXED = {
    0: """{"league_name": "L", "game_date": "2025-01-02", "home_team": "A", "away_team": "B", "score": "1 - 0"}""",
    1: """{"league_name": null, "game_date": "2025-01-02", "home_team": "A", "away_team": "B"}""",
    2: """{"date": "2025-01-02", "games": [{"home_team": "A", "away_team": "B", "league": "L"}, 5]}""",
    3: """{"date": "2025-01-02", "games": []}""",
    4: "",
    5: """{"date": "2025-01-02"}""",
    6: """{"date": "2025-01-02", "games": [null, {"home_team": "A", "away_team": "B", "league": "L"}]}""",
    7: """{"date": "2025-""",
    8: """{"date": "2025-01-02", "games": {"home_team": "A", "away_team": "B", "league": "L", "home_score": "x"}}""",
}


@query(
    "ingest_balance",
    """SELECT o_orderkey % 9 AS kind, count(DISTINCT o_orderkey) AS inputs,
           CASE WHEN o_orderkey % 9 IN (0, 2, 6) THEN count(*) ELSE 0 END AS valid,
           CASE WHEN o_orderkey % 9 IN (1, 2, 4, 5, 7, 8) THEN count(*) ELSE 0 END AS quarantined,
           CASE WHEN o_orderkey % 9 = 3 THEN count(*) ELSE 0 END AS empty
    FROM orders GROUP BY 1""",
)
def ingest_balance(spark, sf_dir):
    """Nothing is lost: every kind of input ends up as games, in quarantine, or as an empty list."""
    kind = F.col("o_orderkey") % len(_MIXED)
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", kind.alias("kind"), F.get(F.lit(list(_MIXED.values())), kind.cast("int")).alias("content")
    )
    cleaned = ingest.ingest(raw, RUN_TS, YEAR)
    inputs = cleaned.groupBy("kind").agg(F.count_distinct("o_orderkey").alias("inputs"))
    return inputs.join(ingest.balance(cleaned, "kind"), "kind")


@query(
    "coerce_numeric",
    f"""WITH {RECORDS_SQL}
    SELECT {_KEYS_SQL}, TRY_CAST(home_score AS BIGINT) AS home_score, TRY_CAST(status AS DOUBLE) AS status FROM feed""",
)
def coerce_numeric(spark, sf_dir):
    return feeds.record_fields(spark, sf_dir).select(
        *_KEYS,
        text.coerce_long(F.col("home_score")).alias("home_score"),
        text.coerce_double(F.col("status")).alias("status"),
    )


@query("coerce_datetime", f"WITH {RECORDS_SQL} SELECT {_KEYS_SQL}, {stamp_sql(STAMP_SQL)} AS stamp FROM feed")
def coerce_datetime(spark, sf_dir):
    return feeds.record_fields(spark, sf_dir).select(*_KEYS, text.iso_wall_clock(F.col("stamp")).alias("stamp"))


@query(
    "date_parts",
    f"""WITH {RECORDS_SQL}, d AS (SELECT {_KEYS_SQL}, {DATE_SQL} AS played FROM feed)
    SELECT {_KEYS_SQL}, CAST(year(played) AS BIGINT) AS year, CAST(month(played) AS BIGINT) AS month,
           CAST(day(played) AS BIGINT) AS day FROM d""",
)
def date_parts(spark, sf_dir):
    dated = feeds.record_fields(spark, sf_dir).select(*_KEYS, text.game_date(F.col("game_day"), YEAR).alias("at"))
    return ingest.date_parts(dated, "at").drop("at")


def _documents(spark, sf_dir):
    return ingest.day_documents(feeds.day_files(spark, sf_dir))


@query(
    "json_date_from_name",
    f"""WITH {FILES_SQL}
    SELECT path, replace(split_part(path, '/', 4), '.json', '') AS file_date,
           CASE kind WHEN 0 THEN 'array' WHEN 3 THEN 'object' WHEN 4 THEN 'broken' ELSE 'games' END AS kind FROM files""",
)
def json_date_from_name(spark, sf_dir):
    return _documents(spark, sf_dir).select("path", "file_date", "kind")


@query(
    "flatten_three_shapes",
    f"""WITH {FILE_GAMES_SQL}
    SELECT path, stem AS date, home_team, away_team, CAST(home_score AS VARCHAR) AS home_score,
           CAST(away_score AS VARCHAR) AS away_score, coalesce(league) AS league FROM file_games""",
)
def flatten_three_shapes(spark, sf_dir):
    games = ingest.flatten_three_shapes(_documents(spark, sf_dir))
    league = F.coalesce("league", "league_name").alias("league")
    return games.select("path", "date", "home_team", "away_team", "home_score", "away_score", league)


_GATED = f"""WITH {FILE_GAMES_SQL}
    SELECT path AS source_file, stem AS source_date, home_team, away_team, league,
           TRY_CAST(split_part(stem, '-', 1) AS BIGINT) AS year, TRY_CAST(split_part(stem, '-', 2) AS BIGINT) AS month,
           TRY_CAST(split_part(stem, '-', 3) AS BIGINT) AS day, '{RUN_TS}.000000' AS processed_at
    FROM file_games WHERE kind = 1"""


def _gated(spark, sf_dir):
    return ingest.flatten_gated(_documents(spark, sf_dir), RUN_TS)


@query("flatten_gated", _GATED)
def flatten_gated(spark, sf_dir):
    columns = ("source_file", "source_date", "home_team", "away_team", "league", "year", "month", "day", "processed_at")
    return _gated(spark, sf_dir).select(*columns)


@query("lineage_columns", f"SELECT source_date, source_file, processed_at, count(*) AS games FROM ({_GATED}) g GROUP BY ALL")
def lineage_columns(spark, sf_dir):
    lineage = ("source_date", "source_file", "processed_at")
    return _gated(spark, sf_dir).groupBy(*lineage).agg(F.count(F.lit(1)).alias("games"))


@query(
    "legacy_to_canonical",
    f"""WITH {FILE_GAMES_SQL}
    SELECT {stamp_sql("file_date")} AS date, home_team, away_team, home_score, away_score, league, '7:00 PM' AS time,
           CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS DOUBLE) AS status,
           CAST(NULL AS VARCHAR) AS headers, '{RUN_TS}.000000' AS timestamp
    FROM file_games WHERE kind IN (0, 1, 2) AND path NOT LIKE '%\\_meta.json' ESCAPE '\\'""",
)
def legacy_to_canonical(spark, sf_dir):
    return ingest.legacy_to_canonical(_documents(spark, sf_dir), RUN_TS)


@query(
    "conversion_stats",
    f"""WITH {FILES_SQL}, f AS (SELECT *, o_orderkey % 7 = 0 AS meta, substr(file_date, 1, 4) AS year FROM files)
    SELECT year, count(*) AS total_files, count(*) FILTER (kind IN (0, 1, 2) AND NOT meta) AS converted_files,
           CAST(2 * count(*) FILTER (kind IN (0, 1, 2) AND NOT meta) AS BIGINT) AS total_games,
           count(*) FILTER (kind = 4 AND NOT meta) AS errors FROM f GROUP BY year""",
)
def conversion_stats(spark, sf_dir):
    documents = _documents(spark, sf_dir).withColumn("year", F.substring("file_date", 1, 4))
    return ingest.conversion_stats(documents, "year")


_UNION = """SELECT o_orderkey AS id, o_orderpriority AS league, CAST(NULL AS VARCHAR) AS flag FROM orders
    UNION ALL SELECT l_orderkey, NULL, l_returnflag FROM lineitem"""


def _parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("league"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("flag"))
    return orders, lines


@query("union_by_name", _UNION)
def union_by_name(spark, sf_dir):
    orders, lines = _parts(spark, sf_dir)
    unfilled = orders.withColumn("nothing", F.lit(None).cast("string"))
    return merge.union_all(merge.filled_columns(unfilled), lines)


@query("union_all", f"SELECT league, flag, count(*) AS n FROM ({_UNION}) u GROUP BY ALL")
def union_all(spark, sf_dir):
    return merge.union_all(*_parts(spark, sf_dir)).groupBy("league", "flag").agg(F.count(F.lit(1)).alias("n"))
