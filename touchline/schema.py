"""Fixed schemas. Reads never infer; dirty text is parsed with ``try_`` casts."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per meeting of two sides. Dates carry no zone.
CANONICAL = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
        T.StructField("league", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("status", T.DoubleType()),
        T.StructField("headers", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

# A game inside a nested record. Scores stay text until they are validated.
GAME_DDL = (
    "struct<home_team:string, away_team:string, home_score:string, away_score:string, "
    "league:string, league_name:string, time:string, status:string, venue:string>"
)

# Both raw shapes in one parse: the flat keys and the nested ones. ``games``
# stays JSON text, since it may hold one game or a list of them.
RAW_RECORD_DDL = (
    "league_name string, game_date string, game_time string, home_team string, "
    "away_team string, score string, field string, game_type string, "
    "date string, games string, type string, url string, status string, headers string, timestamp string"
)

LEDGER = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("games_count", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("new_rows", T.LongType()),
        T.StructField("finished_at", T.TimestampNTZType()),
    ]
)
