"""Queries on stored pages.

The given pages hold no schedule tables, so schedule pages are rendered from
the orders, one page per order, and must give back the rows that went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.functions import text
from touchline.operators import ingest, merge, pages
from touchline.plans.registry import query, stamp_sql
from touchline.plans.tables import RUN_TS, YEAR, table

_FIELDS = {
    "a": "'Side ' || CAST(o_custkey % 40 AS STRING) || ' & Co'",
    "b": "'Side ' || CAST(o_orderkey % 40 AS STRING)",
    "league": "o_orderpriority",
    "score": "CAST(CAST(floor(o_totalprice) AS BIGINT) % 7 AS STRING) || ' - ' || CAST(o_custkey % 5 AS STRING)",
    "venue": "'Field ' || CAST(o_custkey % 9 AS STRING)",
    "day": """CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/'
        || CAST(year(o_orderdate) AS STRING)""",
    "clock": """CAST(1 + o_orderkey % 12 AS STRING) || ':' || lpad(CAST(o_custkey % 60 AS STRING), 2, '0')
        || CASE WHEN o_orderkey % 2 = 0 THEN ' PM' ELSE ' am' END""",
}
_PAGES_SQL = "p AS (SELECT o_orderkey, o_orderdate, {} FROM orders)".format(
    ", ".join(f"{rule} AS {name}" for name, rule in _FIELDS.items())
)


def _fields(spark, sf_dir) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    # Reading a page costs far more than its bytes tell: deal the rows out evenly over a fixed number of tasks.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = table(spark, sf_dir, "orders").select(*columns).repartition(width, "o_orderkey")
    return orders.selectExpr("o_orderkey", "o_orderdate", *[f"{rule} AS {name}" for name, rule in _FIELDS.items()])


def _html(value: Column | str) -> Column:
    """Text as a page writes it: escaped, with stray space around it."""
    column = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit("\n <b> "), F.replace(column, F.lit("&"), F.lit("&amp;")), F.lit("</b> "))


def _row(*values: Column | str, labels: list[str] | None = None) -> Column:
    cells = []
    for i, value in enumerate(values):
        label = f' {fixed.CELL_LABEL_ATTRIBUTE}="{labels[i]}"' if labels else ""
        cells += [F.lit(f"<td{label}>"), _html(value), F.lit("</td>")]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def _table(marker: str, *rows: Column, header: bool = True) -> Column:
    head = "<tr><th>One</th><th>Two</th></tr>" if header else ""
    return F.concat(F.lit(f"<table {marker}>{head}"), *rows, F.lit("</table>"))


def _page(*body: Column) -> Column:
    return F.concat(F.lit("<html><body><br><p>Schedule</p>"), *body, F.lit("</body></html>"))


_LABELS = ["League", "Home", "", "Away", "Time/Status", "Venue", "Officials"]


def _schedule_pages(spark, sf_dir) -> DataFrame:
    """Every marker and layout in turn; the last kind has no table."""
    a, b, league, score, venue = (F.col(c) for c in ("a", "b", "league", "score", "venue"))
    first, second = fixed.SCHEDULE_TABLE_IDS
    decoy = _table('class="other"', _row("x", "x", "x", "x", "x"))
    modern = [
        _row(league, a, score, b, "Complete", venue, "Ref A", labels=_LABELS),
        _row(league, b, "vs", a, "7:00 PM", venue, "", labels=_LABELS),
    ]
    dated = [
        _row(league, a, "Sat-Feb 15", score, "Complete", venue, "Ref A"),
        _row(league, b, "Sun-Feb 16", a, "7:00 PM", venue),
    ]
    plain = [_row(league, a, b, "Complete", venue, "Ref A"), _row(league, b, a, "7:00 PM", venue)]
    short = _row(league, a, b, "four")
    kind = F.col("o_orderkey") % 6
    html = (
        F.when(kind == 0, _page(decoy, _table(f'id="{first}" class="grid"', *modern, short)))
        .when(kind == 1, _page(_table(f'id="{second}"', *dated, short)))
        .when(kind == 2, _page(decoy, _table(f'class="table {fixed.SCHEDULE_TABLE_CLASS}"', *dated)))
        .when(kind == 3, _page(_table(f'class="my-{fixed.BASE_TABLE_CLASS} wide"', *plain, short)))
        .when(kind == 4, _page(_table(f'id="{second}"', *modern)))
        .otherwise(_page(F.lit("<p>No games</p>")))
    )
    return _fields(spark, sf_dir).select("o_orderkey", html.alias("html"))


_KIND_SQL = "o_orderkey % 6"
_SCHEDULE_SQL = f"""{_PAGES_SQL}, games AS (
    SELECT o_orderkey, n AS row_no, {_KIND_SQL} AS kind, league AS league_name, CASE WHEN n = 1 THEN a ELSE b END AS home_team,
           CASE WHEN n = 2 THEN a WHEN {_KIND_SQL} IN (1, 2) THEN '' ELSE b END AS away_team,
           CASE WHEN n = 1 AND {_KIND_SQL} <> 3 THEN score ELSE '' END AS score,
           CASE WHEN n = 1 THEN 'Complete' ELSE '7:00 PM' END AS game_time, venue AS field,
           CASE WHEN n = 1 THEN 'Ref A' ELSE '' END AS officials,
           CASE WHEN {_KIND_SQL} IN (0, 4) THEN 'modern' ELSE 'legacy' END AS table_format
    FROM p, (VALUES (1), (2)) AS copies(n) WHERE {_KIND_SQL} < 5)"""
_GAME = """o_orderkey, CAST(row_no AS BIGINT) AS row_no, league_name, home_team, away_team, score, game_time, field,
    officials, table_format"""


def _schedule_rows(spark, sf_dir) -> DataFrame:
    return pages.table_rows(_schedule_pages(spark, sf_dir), "schedule")


def _schedule_games(spark, sf_dir) -> DataFrame:
    return pages.schedule_games(_schedule_rows(spark, sf_dir))


@query(
    "html_rows",
    f"""WITH {_PAGES_SQL}, r AS (
        SELECT o_orderkey, n, {_KIND_SQL} AS kind, league FROM p, (VALUES (1), (2), (3)) AS copies(n)
        WHERE {_KIND_SQL} < 5 AND (n < 3 OR {_KIND_SQL} IN (0, 1, 3)))
    SELECT o_orderkey, CAST(n AS BIGINT) AS row_no, kind IN (0, 4) AND n < 3 AS marked,
           CAST(CASE WHEN n = 3 THEN 4 WHEN kind IN (0, 4) THEN 7 WHEN kind = 3 THEN 7 - n ELSE 8 - n END AS BIGINT) AS cells,
           league AS first_cell FROM r""",
)
def html_rows(spark, sf_dir):
    rows = _schedule_rows(spark, sf_dir)
    first = F.get("cells", F.lit(0))["text"].alias("first_cell")
    return rows.select("o_orderkey", "row_no", "marked", F.size("cells").cast("bigint").alias("cells"), first)


@query("html_modern", f"WITH {_SCHEDULE_SQL} SELECT {_GAME} FROM games WHERE kind IN (0, 4)")
def html_modern(spark, sf_dir):
    return pages.schedule_games(_schedule_rows(spark, sf_dir).where("marked"))


@query("html_legacy_dated", f"WITH {_SCHEDULE_SQL} SELECT {_GAME} FROM games WHERE kind IN (1, 2)")
def html_legacy_dated(spark, sf_dir):
    third = F.get("cells", F.lit(2))["text"]
    dated = third.startswith("Sat-") | third.startswith("Sun-")
    return pages.schedule_games(_schedule_rows(spark, sf_dir).where(~F.col("marked") & dated))


@query("html_legacy_plain", f"WITH {_SCHEDULE_SQL} SELECT {_GAME} FROM games WHERE kind = 3")
def html_legacy_plain(spark, sf_dir):
    third = F.get("cells", F.lit(2))["text"]
    dated = third.startswith("Sat-") | third.startswith("Sun-")
    return pages.schedule_games(_schedule_rows(spark, sf_dir).where(~F.col("marked") & ~dated))


@query("html_schedule", f"WITH {_SCHEDULE_SQL} SELECT {_GAME} FROM games")
def html_schedule(spark, sf_dir):
    return _schedule_games(spark, sf_dir)


@query(
    "pages_to_games",
    f"""WITH {_SCHEDULE_SQL}, dated AS (
        SELECT strftime(o_orderdate, '%Y-%m-%d 00:00:00.000000') AS date, home_team, away_team, league_name AS league, game_time AS time,
               TRY_CAST(split_part(score, ' - ', 1) AS BIGINT) AS home_score,
               TRY_CAST(split_part(score, ' - ', 2) AS BIGINT) AS away_score,
               CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS stamp, o_orderkey
        FROM games JOIN (SELECT o_orderkey, o_orderdate FROM p) d USING (o_orderkey) WHERE home_team <> '' AND away_team <> ''),
    r AS (SELECT *, row_number() OVER (PARTITION BY date, home_team, away_team, league
            ORDER BY stamp DESC, home_score NULLS LAST, away_score NULLS LAST) AS n FROM dated)
    SELECT date, home_team, away_team, home_score, away_score, league, time,
           {stamp_sql("stamp")} AS timestamp FROM r WHERE n = 1""",
)
def pages_to_games(spark, sf_dir):
    """Stored pages to the table: cells, games, typed and checked rows, newest version of each game."""
    dated = _fields(spark, sf_dir).select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("page_date"),
        F.date_format(F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, "o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("fetched"),
    )
    games = _schedule_games(spark, sf_dir).join(dated, "o_orderkey")
    cleaned = ingest.clean_games(pages.canonical_games(games, "page_date", "fetched"), RUN_TS, YEAR)
    newest = merge.keep_latest(ingest.valid_rows(cleaned), merge.GAME_KEY, "timestamp")
    return newest.select("date", "home_team", "away_team", "home_score", "away_score", "league", "time", "timestamp")


def _event_pages(spark, sf_dir) -> DataFrame:
    a, b, venue = F.col("a"), F.col("b"), F.col("venue")
    base = f'class="{fixed.BASE_TABLE_CLASS}"'

    def rows(description: Column) -> list[Column]:
        return [_row("7:00 PM", "8:00 PM", description, venue), _row("only", "three", "cells")]

    versus, dash = F.concat(a, F.lit(" vs "), b), F.concat(a, F.lit(" - "), b)
    practice = F.concat(b, F.lit(" Practice"))
    header = F.lit("<div><div><h2>Events on Saturday, February 15, 2025</h2></div>")
    kind = F.col("o_orderkey") % 5
    html = (
        F.when(kind == 0, _page(header, _table(base, *rows(versus)), F.lit("</div>")))
        .when(kind == 1, _page(header, _table(base, *rows(dash)), F.lit("</div>")))
        .when(kind == 2, _page(header, _table(base, *rows(practice)), F.lit("</div>")))
        .when(kind == 3, _page(_table(base, *rows(versus), *rows(dash))))
        .otherwise(_page(header, F.lit("</div>")))
    )
    return _fields(spark, sf_dir).select("o_orderkey", html.alias("html"))


@query(
    "html_events_layout",
    f"""WITH {_PAGES_SQL}, e AS (
        SELECT o_orderkey, n, o_orderkey % 5 AS kind, a, b, venue,
               CASE WHEN o_orderkey % 5 = 0 OR (o_orderkey % 5 = 3 AND n = 1) THEN a || ' vs ' || b
                    WHEN o_orderkey % 5 = 2 THEN b || ' Practice' ELSE a || ' - ' || b END AS description
        FROM p, (VALUES (1), (2)) AS copies(n) WHERE o_orderkey % 5 < 4 AND (n = 1 OR o_orderkey % 5 = 3))
    SELECT o_orderkey, CAST(n AS BIGINT) AS row_no, '7:00 PM' AS start_time, '8:00 PM' AS end_time, description,
           venue AS field, CASE WHEN kind = 2 OR (kind = 3 AND n = 2) THEN description ELSE a END AS home_team,
           CASE WHEN kind = 2 THEN 'Practice' WHEN kind = 3 AND n = 2 THEN 'Unknown' ELSE b END AS away_team FROM e""",
)
def html_events_layout(spark, sf_dir):
    return pages.event_games(pages.table_rows(_event_pages(spark, sf_dir), "events"))


@query(
    "description_split",
    f"""WITH {_PAGES_SQL}, d AS (SELECT o_orderkey, a, b, CASE o_orderkey % 4 WHEN 0 THEN a || ' vs ' || b
        WHEN 1 THEN b || ' - ' || a WHEN 2 THEN b || ' Practice' ELSE 'Practice' END AS description FROM p)
    SELECT o_orderkey, description,
           CASE o_orderkey % 4 WHEN 0 THEN a WHEN 1 THEN b ELSE description END AS home_team,
           CASE o_orderkey % 4 WHEN 0 THEN b WHEN 1 THEN a WHEN 2 THEN 'Practice' ELSE 'Unknown' END AS away_team FROM d""",
)
def description_split(spark, sf_dir):
    kind = F.col("o_orderkey") % 4
    description = (
        F.when(kind == 0, F.concat("a", F.lit(" vs "), "b"))
        .when(kind == 1, F.concat("b", F.lit(" - "), "a"))
        .when(kind == 2, F.concat("b", F.lit(" Practice")))
        .otherwise("Practice")
    )
    described = _fields(spark, sf_dir).select("o_orderkey", description.alias("description"))
    home, away = text.split_description(F.col("description"))
    return described.select("o_orderkey", "description", home.alias("home_team"), away.alias("away_team"))


def _grid_pages(spark, sf_dir, with_league: bool) -> DataFrame:
    tail = [F.col("league")] if with_league else []
    a, b, venue, day, clock = (F.col(c) for c in ("a", "b", "venue", "day", "clock"))
    rows = [
        _row(day, clock, a, b, venue, *tail),
        _row("someday", clock, a, b, venue, *tail),
        _row(day, "13:00 PM", a, b, venue, *tail),
        _row(day, clock, a, b),
    ]
    html = _page(_table(f'id="{fixed.GRID_TABLE_ID}"', *rows))
    path = F.concat(F.lit("/pages/league_schedule_"), "league", F.lit(".html"))
    return _fields(spark, sf_dir).select("o_orderkey", path.alias("path"), html.alias("html"))


_GRID_SQL = f"""{_PAGES_SQL}, grid AS (
    SELECT o_orderkey, CAST(1 AS BIGINT) AS row_no, strftime(o_orderdate, '%Y-%m-%d') AS date,
           lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0') || ':' || split_part(upper(clock), ':', 2) AS time,
           a AS home_team, b AS away_team, venue AS field, league AS league_name FROM p)"""


def _daily(spark, sf_dir) -> DataFrame:
    return pages.grid_games(pages.table_rows(_grid_pages(spark, sf_dir, True).drop("path"), "grid"))


def _league(spark, sf_dir) -> DataFrame:
    rows = pages.table_rows(_grid_pages(spark, sf_dir, False), "grid")
    return pages.grid_games(rows, league=pages.league_of_file()).drop("path")


@query("html_grid_daily", f"WITH {_GRID_SQL} SELECT * FROM grid")
def html_grid_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


@query("html_grid_league", f"WITH {_GRID_SQL} SELECT * FROM grid")
def html_grid_league(spark, sf_dir):
    return _league(spark, sf_dir)


@query("html_day_counts", f"WITH {_GRID_SQL} SELECT date, 2 * count(*) AS games FROM grid GROUP BY date")
def html_day_counts(spark, sf_dir):
    both = _daily(spark, sf_dir).unionByName(_league(spark, sf_dir))
    return both.groupBy("date").agg(F.count(F.lit(1)).alias("games"))


@query(
    "html_scan",
    """SELECT page_id, length(html) AS n_chars, html LIKE '%<table%' AS has_table, CAST(0 AS BIGINT) AS table_rows
    FROM pages""",
)
def html_scan(spark, sf_dir):
    """The given pages: whole texts are scanned, and none has a schedule table."""
    stored = table(spark, sf_dir, "pages")
    found = pages.table_rows(stored.select("page_id", "html"), "schedule")
    counts = found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    return stored.join(counts, "page_id", "left").select(
        "page_id",
        F.length("html").cast("bigint").alias("n_chars"),
        F.contains("html", F.lit("<table")).alias("has_table"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("table_rows"),
    )
