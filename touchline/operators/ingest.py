"""Raw JSON records to the canonical table, with a quarantine for bad rows.

All steps are narrow: parse, route by shape, flatten, clean, check. A run stays
one scan with one projection chain, whatever the mix of shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import text
from touchline.schema import CANONICAL, GAME_DDL, RAW_RECORD_DDL

UNPARSABLE = "record"
EMPTY = "empty"
_CORRUPT = "_corrupt"
_RECORD_FIELDS = [
    "league_name", "game_date", "game_time", "home_team", "away_team", "score", "game_type",
    "date", "games", "type", "url", "status", "headers", "timestamp",
]


def parse_records(raw: DataFrame, content: str = "content") -> DataFrame:
    """Parse JSON objects into a ``record`` struct and name the ``shape`` of each.

    ``flat`` records have the keys of both their league and their date, also
    with null values; others are ``nested``; text the reader could not use is
    ``unparsable``. The parse is put in a one-row ``inline``, so later filters
    cannot make it run twice.
    """
    record = F.from_json(F.col(content), f"{RAW_RECORD_DDL}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    keys = F.json_object_keys(content)
    # Text without the names has no such keys, unless a name is escaped; only other text is read for its keys.
    named = F.contains(F.col(content), F.lit("league_name")) & F.contains(F.col(content), F.lit("game_date"))
    named |= F.contains(F.col(content), F.lit("\\"))
    flat = F.when(named, F.array_contains(keys, "league_name") & F.array_contains(keys, "game_date"))
    others = [c for c in raw.columns if c != content]
    names = [f"_{n}" for n in _names(RAW_RECORD_DDL)]
    parsed = raw.select(*others, F.coalesce(flat, F.lit(False)).alias("_flat"), F.inline(F.array(record)).alias(*names, _CORRUPT))
    shape = F.when(F.col(_CORRUPT).isNotNull(), "unparsable").when(F.col("_flat"), "flat").otherwise("nested")
    fields = F.struct(*[F.col(f"_{n}").alias(n) for n in _RECORD_FIELDS])
    return parsed.select(*others, shape.alias("shape"), fields.alias("record"))


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def explode_games(parsed: DataFrame) -> DataFrame:
    """One row per game of either shape, as a ``game`` struct of loose fields.

    The flat shape is renamed to canonical names; the nested one takes the
    fields of its record, which holds one game or a list. Each element is read
    alone, so a bad one costs no other. Every input leaves a row: null
    elements are skipped, but a list without any game keeps one row with shape
    ``empty``, and whatever cannot be read as a game keeps one with shape
    ``unparsable``, so that it can be quarantined.
    """
    others = [c for c in parsed.columns if c not in ("record", "shape")]
    fields = parsed.select(*others, "shape", *[F.col(f"record.{n}").alias(f"_{n}") for n in _RECORD_FIELDS])
    body = F.trim("_games")
    many = F.filter(F.from_json("_games", "array<string>"), lambda e: e.isNotNull())
    listed = F.when(F.col("shape") == "nested", F.when(body.startswith("["), many).otherwise(F.array("_games")))
    rows = fields.select("*", F.posexplode_outer(listed).alias("_pos", "_game"))
    # A one-row inline here too: filters on the shape would read every game twice.
    read = F.when(F.ltrim("_game").startswith("{"), F.from_json("_game", GAME_DDL))
    rows = rows.select("*", F.inline(F.array(F.struct(read.alias("g")))))
    nothing = F.col("_pos").isNull() & body.startswith("[") & body.endswith("]")
    nested = F.when(F.coalesce(nothing, F.lit(False)), "empty").when(F.col("g").isNull(), "unparsable").otherwise("nested")
    rows = rows.withColumn("shape", F.when(F.col("shape") == "nested", nested).otherwise(F.col("shape")))
    home, away = text.score_parts(F.col("_score"))
    nested_home, nested_away = text.coerce_long(F.col("g.home_score")), text.coerce_long(F.col("g.away_score"))
    bad = (F.col("g.home_score").isNotNull() & nested_home.isNull()) | (
        F.col("g.away_score").isNotNull() & nested_away.isNull()
    )
    flat = F.col("shape") == "flat"
    either = lambda a, b: F.when(flat, F.col(a)).otherwise(F.col(b))
    game = F.struct(
        either("_game_date", "_date").alias("date"),
        either("_home_team", "g.home_team").alias("home_team"),
        either("_away_team", "g.away_team").alias("away_team"),
        F.when(flat, home).otherwise(nested_home).alias("home_score"),
        F.when(flat, away).otherwise(nested_away).alias("away_score"),
        F.when(flat, F.lit(False)).otherwise(bad).alias("bad_score"),
        either("_league_name", "g.league").alias("league"),
        either("_game_time", "g.time").alias("time"),
        F.col("_url").alias("url"),
        either("_game_type", "_type").alias("type"),
        F.col("_status").alias("status"),
        F.col("_headers").alias("headers"),
        F.col("_timestamp").alias("timestamp"),
    )
    return rows.select(*others, "shape", game.alias("game"))


def clean_games(games: DataFrame, run_ts: str, year: int) -> DataFrame:
    """Typed canonical columns and the failed rules per game, comma-separated in ``errors``.

    ``run_ts`` stands for now and ``year`` for the current year, so a run can
    be repeated with the same result.
    """
    g = lambda name: F.col(f"game.{name}")
    others = [c for c in games.columns if c not in ("game", "shape")]
    # A one-row inline again: the check filters on these values, and pushing it
    # below a plain projection would parse every date twice.
    values = F.struct(
        text.game_date(g("date"), year).alias("date"),
        text.strip_text(g("home_team")).alias("home_team"),
        text.strip_text(g("away_team")).alias("away_team"),
        text.strip_text(g("league")).alias("league"),
        text.coerce_double(g("status")).alias("status"),
        text.utc_stamp(g("timestamp")).alias("timestamp"),
    )
    typed = games.select(*others, "shape", "game", F.inline(F.array(values)))
    blank = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    rules = [
        ("date", F.col("date").isNull()),
        ("home_team", blank("home_team")),
        ("away_team", blank("away_team")),
        ("league", blank("league")),
        ("score", g("bad_score") | (g("home_score") < 0) | (g("away_score") < 0)),
        ("url", ~text.web_address_ok(g("url"))),
        ("status", g("status").isNotNull() & ~F.coalesce(F.col("status").between(0, 1), F.lit(False))),
        ("timestamp", g("timestamp").isNotNull() & F.col("timestamp").isNull()),
    ]
    failed = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in rules])
    errors = F.when(F.col("shape") == "unparsable", F.lit(UNPARSABLE)).otherwise(failed)
    kept = {name: g(name) for name in ("home_score", "away_score", "time", "url", "type", "headers")}
    kept["timestamp"] = F.coalesce("timestamp", F.lit(run_ts).cast("timestamp_ntz"))
    return typed.select(
        *others,
        "shape",
        *[kept.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in CANONICAL],
        errors.alias("errors"),
    )


def valid_rows(cleaned: DataFrame) -> DataFrame:
    """Games that pass every rule, in the canonical schema."""
    return cleaned.where((F.col("errors") == "") & (F.col("shape") != EMPTY)).select(*CANONICAL.names)


def quarantine_rows(cleaned: DataFrame) -> DataFrame:
    """Games that fail a rule, with the failed rules and whatever identifies the input."""
    failed = cleaned.where((F.col("errors") != "") & (F.col("shape") != EMPTY))
    return failed.withColumn("errors", F.split("errors", ","))


def ingest(raw: DataFrame, run_ts: str, year: int, content: str = "content") -> DataFrame:
    """Parse, flatten, clean and check; split the result with the two functions above."""
    return clean_games(explode_games(parse_records(raw, content)), run_ts, year)


def balance(cleaned: DataFrame, *keys: str) -> DataFrame:
    """Rows per key: valid games, quarantined ones, and inputs whose list of games is empty."""
    empty = F.col("shape") == EMPTY
    return cleaned.groupBy(*keys).agg(
        F.count_if((F.col("errors") == "") & ~empty).alias("valid"),
        F.count_if((F.col("errors") != "") & ~empty).alias("quarantined"),
        F.count_if(empty).alias("empty"),
    )


# Day files of the older layouts: a document per file, dated by its name.


def file_stem(path: str = "path") -> Column:
    """File name without directories and ``.json``."""
    return F.replace(F.element_at(F.split(F.col(path), "/"), -1), F.lit(".json"), F.lit(""))


_DAY_DDL = (
    f"date string, games_found boolean, games array<{GAME_DDL}>, home_team string, away_team string, "
    "home_score string, away_score string, league string, league_name string, time string, status string, venue string"
)


def day_documents(docs: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Classify day files as ``array``, ``games``, ``object`` or ``broken`` and parse them once."""
    body = F.ltrim(F.col(content))
    listed = F.ltrim(F.get_json_object(content, "$.games")).startswith("[")
    value = F.try_parse_json(content)
    kind = (
        F.when(value.isNull(), "broken")
        .when(body.startswith("["), "array")
        .when(body.startswith("{") & F.coalesce(listed, F.lit(False)), "games")
        .when(body.startswith("{"), "object")
        .otherwise("broken")
    )
    others = [c for c in docs.columns if c not in (path, content)]
    return docs.select(*others, path, content, kind.alias("kind"), file_stem(path).alias("file_date")).select(
        *others,
        path,
        "kind",
        "file_date",
        F.when(F.col("kind") == "array", F.from_json(F.col(content), f"array<{GAME_DDL}>")).alias("listed"),
        F.when(F.col("kind").isin("games", "object"), F.from_json(F.col(content), _DAY_DDL)).alias("day"),
    )


def flatten_three_shapes(documents: DataFrame) -> DataFrame:
    """Games of every readable day file; the file name gives the date."""
    single = F.array(F.struct(*[F.col(f"day.{f}").alias(f) for f in _game_fields()]))
    games = (
        F.when(F.col("kind") == "array", F.col("listed"))
        .when(F.col("kind") == "games", F.col("day.games"))
        .when(F.col("kind") == "object", single.cast(f"array<{GAME_DDL}>"))
    )
    rows = documents.select("path", F.col("file_date").alias("date"), F.explode(games).alias("game"))
    return rows.where(F.col("game").isNotNull()).select("path", "date", "game.*")


def _game_fields() -> list[str]:
    return [part.split(":")[0].strip() for part in GAME_DDL[len("struct<") : -1].split(",")]


def flatten_gated(documents: DataFrame, run_ts: str) -> DataFrame:
    """Games of files that say they found some, with lineage columns."""
    gate = (F.col("kind") == "games") & F.coalesce(F.col("day.games_found"), F.lit(False))
    rows = documents.where(gate).select("path", "file_date", F.explode("day.games").alias("game"))
    parts = F.split("file_date", "-")
    part = lambda i: F.when(F.contains(F.col("file_date"), F.lit("-")), F.get(parts, F.lit(i)).try_cast("bigint"))
    return rows.select(
        "game.*",
        F.col("file_date").alias("source_date"),
        part(0).alias("year"),
        part(1).alias("month"),
        part(2).alias("day"),
        F.lit(run_ts).cast("timestamp_ntz").alias("processed_at"),
        F.col("path").alias("source_file"),
    )


def legacy_to_canonical(documents: DataFrame, run_ts: str) -> DataFrame:
    """Older day files as canonical rows without url, type, status and headers.

    A file with ``games`` dates itself and names the league ``league``; a bare
    array is dated by its name and names it ``league_name``. Meta files and
    other shapes give nothing.
    """
    data = documents.where(~F.endswith(F.col("path"), F.lit("_meta.json")))
    own = F.col("kind") == "games"
    games = F.when(own, F.col("day.games")).when(F.col("kind") == "array", F.col("listed"))
    rows = data.select(
        "path",
        F.when(own, F.col("day.date")).otherwise(F.col("file_date")).alias("date"),
        own.alias("own"),
        F.explode(games).alias("game"),
    )
    league = F.when(F.col("own"), F.col("game.league")).otherwise(F.col("game.league_name"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    nothing = lambda t: F.lit(None).cast(t)
    return rows.select(
        text.iso_wall_clock(F.col("date")).alias("date"),
        blank(F.col("game.home_team")).alias("home_team"),
        blank(F.col("game.away_team")).alias("away_team"),
        text.coerce_long(F.col("game.home_score")).alias("home_score"),
        text.coerce_long(F.col("game.away_score")).alias("away_score"),
        blank(league).alias("league"),
        F.col("game.time").alias("time"),
        nothing("string").alias("url"),
        nothing("string").alias("type"),
        nothing("double").alias("status"),
        nothing("string").alias("headers"),
        F.lit(run_ts).cast("timestamp_ntz").alias("timestamp"),
    )


def conversion_stats(documents: DataFrame, *keys: str) -> DataFrame:
    """Files, converted files, games and unreadable files, meta files counted as files only."""
    data = ~F.endswith(F.col("path"), F.lit("_meta.json"))
    games = F.when(F.col("kind") == "games", F.size("day.games")).when(F.col("kind") == "array", F.size("listed"))
    games = F.when(data, F.coalesce(games, F.lit(0))).otherwise(F.lit(0))
    return documents.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(games > 0).alias("converted_files"),
        F.sum(games).cast("bigint").alias("total_games"),
        F.count_if(data & (F.col("kind") == "broken")).alias("errors"),
    )


def date_parts(df: DataFrame, date: str) -> DataFrame:
    """Year, month and day of a stamp."""
    return df.withColumns({p: F.extract(F.lit(p), F.col(date)).cast("bigint") for p in ("year", "month", "day")})
