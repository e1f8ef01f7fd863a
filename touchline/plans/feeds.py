"""Raw feeds derived from the given tables, clean rows and defects mixed by rule.

The field rules are SQL that both engines read, so a query and its counterpart
start from the same raw values; what follows is written twice, in Spark
columns and in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans.tables import table

_NBSP = " "
_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"

# One raw record per line item.
RECORD_FIELDS = {
    "shape": """CASE WHEN l_orderkey % 2 = 0 THEN 'flat' WHEN l_orderkey % 4 = 1 THEN 'object' ELSE 'array' END""",
    "broken": "l_partkey % 211 = 0",
    "home_team": f"""CASE WHEN l_partkey % 97 = 0 THEN '   '
        WHEN l_partkey % 89 = 0 THEN '{_NBSP} Side ' || CAST(l_suppkey % 40 AS STRING) || '{_NBSP}'
        ELSE 'Side ' || CAST(l_suppkey % 40 AS STRING) END""",
    "away_team": """CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE 'Side ' || CAST(l_partkey % 40 AS STRING) END""",
    "league": """CASE WHEN l_partkey % 103 = 0 THEN '' ELSE ' League ' || l_returnflag || l_linestatus END""",
    "score": """CASE WHEN l_partkey % 31 = 0 THEN 'not a score'
        WHEN l_partkey % 37 = 0 THEN CAST(CAST(floor(l_quantity) AS BIGINT) % 7 AS STRING) || ' - x'
        WHEN l_partkey % 41 = 0 THEN 'x - ' || CAST(CAST(floor(l_extendedprice) AS BIGINT) % 7 AS STRING)
        WHEN l_partkey % 43 = 0 THEN '1 - 2 - 3'
        WHEN l_partkey % 47 = 0 THEN NULL
        ELSE CAST(CAST(floor(l_quantity) AS BIGINT) % 7 AS STRING) || ' - '
             || CAST(CAST(floor(l_extendedprice) AS BIGINT) % 7 AS STRING) END""",
    "home_score": """CASE WHEN l_partkey % 53 = 0 THEN '-1' WHEN l_partkey % 59 = 0 THEN 'x'
        WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(floor(l_quantity) AS BIGINT) % 7 AS STRING) END""",
    "away_score": "CAST(CAST(floor(l_extendedprice) AS BIGINT) % 7 AS STRING)",
    "url": """CASE WHEN l_partkey % 61 = 0 THEN 'ftp://example.org' WHEN l_partkey % 67 = 0 THEN ''
        WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN 'http://example.org/'
        ELSE 'https://example.org/' || CAST(l_orderkey AS STRING) END""",
    "status": """CASE WHEN l_partkey % 73 = 0 THEN '1.5' WHEN l_partkey % 79 = 0 THEN NULL
        WHEN l_partkey % 83 = 0 THEN 'bad' ELSE '0.' || CAST(l_linenumber AS STRING) END""",
    "game_day": f"""CASE WHEN l_partkey % 13 = 0 THEN {_DAY} || 'T10:30:00-05:00'
        WHEN l_partkey % 17 = 0 THEN {_DAY} || 'T23:59:59Z'
        WHEN l_partkey % 19 = 0 THEN 'Sat-Jun ' || CAST(1 + l_linenumber AS STRING)
        WHEN l_partkey % 23 = 0 THEN 'Xyz-Foo 9'
        WHEN l_partkey % 29 = 0 THEN 'Mon-Feb 30'
        WHEN l_partkey % 107 = 0 THEN 'someday' WHEN l_partkey % 109 = 0 THEN '2024-1-5'
        ELSE {_DAY} END""",
    "stamp": f"""CASE WHEN l_partkey % 7 = 0 THEN {_DAY} || 'T08:00:00'
        WHEN l_partkey % 11 = 0 THEN {_DAY} || 'T08:00:00.250000+02:00'
        WHEN l_partkey % 127 = 0 THEN 'never' WHEN l_partkey % 131 = 0 THEN NULL
        ELSE {_DAY} || ' 08:15:00' END""",
}
_RECORD_KEYS = ["l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_partkey", "l_suppkey"]

RECORDS_SQL = "feed AS (SELECT {} FROM lineitem)".format(
    ", ".join([*_RECORD_KEYS, *(f"{rule} AS {name}" for name, rule in RECORD_FIELDS.items())])
)

DATE_SQL = """CASE WHEN game_day LIKE '____-__-__' THEN CAST(game_day AS TIMESTAMP)
    WHEN game_day LIKE '____-__-__T%' THEN CAST(replace(substr(game_day, 1, 19), 'T', ' ') AS TIMESTAMP)
    WHEN game_day LIKE 'Sat-Jun %' THEN make_timestamp(2025, 6, CAST(substr(game_day, 9) AS BIGINT), 0, 0, 0)
    WHEN game_day = 'Xyz-Foo 9' THEN TIMESTAMP '2025-01-09' END"""
STAMP_SQL = """CASE WHEN stamp LIKE '%.250000+02:00' THEN CAST(replace(substr(stamp, 1, 26), 'T', ' ') AS TIMESTAMP)
    WHEN stamp LIKE '____-__-__%' THEN CAST(replace(substr(stamp, 1, 19), 'T', ' ') AS TIMESTAMP) END"""


def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw values as columns.

    Rows are dealt over a fixed number of tasks by their key: a row costs more
    than its bytes tell, so partitions of equal bytes would leave cores idle.
    """
    lines = table(spark, sf_dir, "lineitem").drop("l_discount", "l_tax")
    lines = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey", "l_linenumber")
    return lines.selectExpr(*_RECORD_KEYS, *[f"{rule} AS {name}" for name, rule in RECORD_FIELDS.items()])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw values as JSON text in ``content``: flat, nested object and nested array."""
    f = record_fields(spark, sf_dir)
    flat = F.to_json(
        F.struct(
            F.col("league").alias("league_name"),
            F.col("game_day").alias("game_date"),
            F.lit("10:00 AM").alias("game_time"),
            "home_team",
            "away_team",
            "score",
            F.lit("Field 1").alias("field"),
            "url",
            F.lit("regular").alias("game_type"),
            "status",
            F.col("stamp").alias("timestamp"),
        )
    )

    def game(home: str, away: str):
        return F.struct(
            F.col(home).alias("home_team"),
            F.col(away).alias("away_team"),
            "home_score",
            "away_score",
            "league",
            F.lit("11:00 AM").alias("time"),
        )

    def nested(games):
        return F.to_json(
            F.struct(
                F.col("game_day").alias("date"),
                games.alias("games"),
                "url",
                F.lit("league").alias("type"),
                "status",
                F.col("stamp").alias("timestamp"),
            )
        )

    first, second = game("home_team", "away_team"), game("away_team", "home_team")
    listed = F.array(first, F.when(F.lit(False), first), second)
    whole = (
        F.when(F.col("shape") == "flat", flat)
        .when(F.col("shape") == "object", nested(first))
        .otherwise(nested(listed))
    )
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    f = f.select(*keys, "broken", whole.alias("whole"))
    cut = F.substring("whole", F.lit(1), F.length("whole") - 3)
    return f.select(*keys, F.when(F.col("broken"), cut).otherwise(F.col("whole")).alias("content"))


# The same games after parsing: one row per game, still unchecked.
GAMES_SQL = f"""{RECORDS_SQL}, games AS (
    SELECT l_orderkey, l_linenumber, l_partkey, 'flat' AS shape, game_day, home_team, away_team, league,
           CASE WHEN l_partkey % 31 = 0 OR (l_partkey % 37 <> 0 AND (l_partkey % 41 = 0 OR l_partkey % 43 = 0
                OR l_partkey % 47 = 0)) THEN NULL ELSE CAST(split_part(score, ' - ', 1) AS BIGINT) END AS hs,
           CASE WHEN l_partkey % 31 = 0 OR l_partkey % 37 = 0 OR l_partkey % 41 = 0 OR l_partkey % 43 = 0
                OR l_partkey % 47 = 0 THEN NULL ELSE CAST(split_part(score, ' - ', 2) AS BIGINT) END AS aws,
           FALSE AS bad_score, '10:00 AM' AS time, 'regular' AS type, url, status, stamp
    FROM feed WHERE shape = 'flat' AND NOT broken
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, 'nested', game_day,
           CASE WHEN n = 1 THEN home_team ELSE away_team END, CASE WHEN n = 1 THEN away_team ELSE home_team END,
           league, TRY_CAST(home_score AS BIGINT), CAST(away_score AS BIGINT), coalesce(home_score = 'x', FALSE),
           '11:00 AM', 'league', url, status, stamp
    FROM feed, (VALUES (1), (2)) AS copies(n)
    WHERE shape <> 'flat' AND NOT broken AND (n = 1 OR shape = 'array'))"""

_TRIM = f"trim(?, ' {_NBSP}')"


def trim_sql(name: str) -> str:
    return _TRIM.replace("?", name)


# One day file per order: array, games, gated games, single object, broken, empty.
_ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
FILE_FIELDS = {
    "kind": "o_orderkey % 6",
    "file_date": _ORDER_DAY,
    "path": f"""'/feed/' || CAST(o_orderkey AS STRING) || '/' || {_ORDER_DAY}
        || CASE WHEN o_orderkey % 7 = 0 THEN '_meta.json' ELSE '.json' END""",
    "side_a": "'Side ' || CAST(o_custkey % 40 AS STRING)",
    "side_b": "'Side ' || CAST(o_orderkey % 40 AS STRING)",
    "score_a": "CAST(floor(o_totalprice) AS BIGINT) % 7",
    "score_b": "o_custkey % 5",
    "league": "o_orderpriority",
}
FILES_SQL = "files AS (SELECT o_orderkey, {} FROM orders)".format(
    ", ".join(f"{rule} AS {name}" for name, rule in FILE_FIELDS.items())
)


def day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, path, content)``: day files of every older layout."""
    orders = table(spark, sf_dir, "orders")
    f = orders.selectExpr("o_orderkey", *[f"{rule} AS {name}" for name, rule in FILE_FIELDS.items()])

    def game(a: str, b: str, league: str):
        return F.struct(
            F.col(f"side_{a}").alias("home_team"),
            F.col(f"side_{b}").alias("away_team"),
            F.col(f"score_{a}").alias("home_score"),
            F.col(f"score_{b}").alias("away_score"),
            F.col("league").alias(league),
            F.lit("7:00 PM").alias("time"),
        )

    def listed(league: str):
        return F.array(game("a", "b", league), game("b", "a", league))

    def day(found, games):
        return F.to_json(
            F.struct(F.col("file_date").alias("date"), F.lit(found).alias("games_found"), games.alias("games"))
        )

    kind = F.col("kind")
    content = (
        F.when(kind == 0, F.to_json(listed("league_name")))
        .when(kind == 1, day(True, listed("league")))
        .when(kind == 2, day(False, listed("league")))
        .when(kind == 3, F.to_json(game("a", "b", "league")))
        .when(kind == 4, F.lit('{"date": "2024-01-01", "games": ['))
        .otherwise(day(True, F.slice(listed("league"), 1, 0)))
    )
    return f.select("o_orderkey", "path", content.alias("content"))


# Games of the day files: two per listed file, one per single object.
FILE_GAMES_SQL = f"""{FILES_SQL}, file_games AS (
    SELECT o_orderkey, kind, path, replace(split_part(path, '/', 4), '.json', '') AS stem, file_date, league,
           CASE WHEN n = 1 THEN side_a ELSE side_b END AS home_team,
           CASE WHEN n = 1 THEN side_b ELSE side_a END AS away_team,
           CASE WHEN n = 1 THEN score_a ELSE score_b END AS home_score,
           CASE WHEN n = 1 THEN score_b ELSE score_a END AS away_score
    FROM files, (VALUES (1), (2)) AS copies(n) WHERE kind IN (0, 1, 2) OR (kind = 3 AND n = 1))"""
