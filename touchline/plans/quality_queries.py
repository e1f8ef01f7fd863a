"""Queries on game checks and run roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.operators import chains, quality, runs
from touchline.plans.registry import day_sql, query, stamp_sql
from touchline.plans.tables import table

# Parsed games with defects by rule, in SQL that both engines read.
_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
_GAME_FIELDS = {
    "date": f"""CASE WHEN l_partkey % 11 = 0 THEN '' WHEN l_partkey % 13 = 0 THEN NULL
        WHEN l_partkey % 17 = 0 THEN '2024-1-5' WHEN l_partkey % 19 = 0 THEN '2024-02-30'
        WHEN l_partkey % 37 = 0 THEN '05/01/2024' ELSE {_DAY} END""",
    "league_name": "CASE WHEN l_partkey % 23 = 0 THEN '' ELSE l_returnflag END",
    "home_team": "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE 'Side ' || CAST(l_suppkey % 10 AS STRING) END",
    "away_team": "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE 'Side ' || CAST(l_partkey % 10 AS STRING) END",
    "field": """CASE WHEN l_partkey % 7 = 0 THEN 'Court 1' WHEN l_partkey % 31 = 0 THEN NULL
        ELSE 'Field ' || CAST(l_linenumber AS STRING) END""",
}
_GAMES_SQL = "games AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {} FROM lineitem)".format(
    ", ".join(f"{rule} AS {name}" for name, rule in _GAME_FIELDS.items())
)
_GOOD_DATE = "(coalesce(date, '') LIKE '____-__-__' AND date <> '2024-02-30' OR coalesce(date, '') = '2024-1-5')"
_CHECKS = [
    *[f"CASE WHEN coalesce({n}, '') = '' THEN '{fixed.MISSING_FIELD}{n}' END" for n in fixed.REQUIRED_FIELDS],
    f"CASE WHEN NOT {_GOOD_DATE} THEN '{fixed.BAD_DATE}' END",
    f"CASE WHEN home_team IS NOT DISTINCT FROM away_team THEN '{fixed.SAME_TEAM}' END",
    f"CASE WHEN coalesce(field, '') <> '' AND field NOT LIKE 'Field%' THEN '{fixed.BAD_FIELD}' END",
]
_KEYS = ("l_orderkey", "l_linenumber")


def _games(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber"]
    return lines.selectExpr(*keys, *[f"{rule} AS {name}" for name, rule in _GAME_FIELDS.items()])


def _errors_sql(checks: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(checks)}], lambda e: e IS NOT NULL), '|')"


@query(
    "errors_required",
    f"WITH {_GAMES_SQL} SELECT l_orderkey, l_linenumber, {_errors_sql(_CHECKS[:5])} AS errors FROM games",
)
def errors_required(spark, sf_dir):
    errors = F.array_compact(F.array(*quality.required_errors()))
    return _games(spark, sf_dir).select(*_KEYS, errors.alias("errors"))


@query("errors_date", f"WITH {_GAMES_SQL} SELECT l_orderkey, l_linenumber, date, {_CHECKS[5]} AS error FROM games")
def errors_date(spark, sf_dir):
    return _games(spark, sf_dir).select(*_KEYS, "date", quality.date_error().alias("error"))


@query("errors_same_team", f"WITH {_GAMES_SQL} SELECT l_orderkey, l_linenumber, {_CHECKS[6]} AS error FROM games")
def errors_same_team(spark, sf_dir):
    return _games(spark, sf_dir).select(*_KEYS, quality.same_side_error().alias("error"))


@query("errors_field", f"WITH {_GAMES_SQL} SELECT l_orderkey, l_linenumber, {_CHECKS[7]} AS error FROM games")
def errors_field(spark, sf_dir):
    return _games(spark, sf_dir).select(*_KEYS, quality.field_error().alias("error"))


@query(
    "validation_errors",
    f"WITH {_GAMES_SQL} SELECT l_orderkey, l_linenumber, {_errors_sql(_CHECKS)} AS errors FROM games",
)
def validation_errors(spark, sf_dir):
    return quality.with_errors(_games(spark, sf_dir)).select(*_KEYS, "errors")


# Day files: one small file per order, two games each; some are broken or empty. More days are expected than there are.
_FILES_SQL = """files AS (
    SELECT CAST(o_orderdate AS DATE) AS file_date,
           CASE WHEN o_orderkey % 17 = 0 AND day(o_orderdate) % 3 = 0 THEN 'invalid_json' ELSE 'validated' END AS status,
           CASE WHEN o_orderkey % 17 = 0 AND day(o_orderdate) % 3 = 0 THEN 0 WHEN o_orderkey % 11 = 0 THEN 0 ELSE 2 END AS n,
           CASE WHEN o_orderkey % 17 = 0 AND day(o_orderdate) % 3 = 0 THEN 0 WHEN o_orderkey % 11 = 0 THEN 0
                WHEN o_custkey % 5 = 0 THEN 1 ELSE 2 END AS valid
    FROM orders),
    span AS (SELECT min(CAST(o_orderdate AS DATE)) - 40 AS a, max(CAST(o_orderdate AS DATE)) + 40 AS b FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS file_date FROM span),
    report AS (
    SELECT d.file_date, coalesce(min(status), 'missing') AS status, CAST(coalesce(sum(n), 0) AS BIGINT) AS games_count,
           CAST(coalesce(sum(valid), 0) AS BIGINT) AS valid_games_count
    FROM days d LEFT JOIN files f ON d.file_date = f.file_date GROUP BY d.file_date)"""


def _day_files(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")

    def game(field):
        return F.struct(
            day.cast("string").alias("date"),
            F.col("o_orderpriority").alias("league_name"),
            F.lit("A").alias("home_team"),
            F.lit("B").alias("away_team"),
            field.alias("field"),
            F.lit("7:00 PM").alias("time"),
        )

    second = F.when(F.col("o_custkey") % 5 == 0, "Court 2").otherwise("Field 2")
    content = (
        F.when((F.col("o_orderkey") % 17 == 0) & (F.dayofmonth(day) % 3 == 0), F.lit('[{"date": '))
        .when(F.col("o_orderkey") % 11 == 0, F.lit("[]"))
        .otherwise(F.to_json(F.array(game(F.lit("Field 1")), game(second))))
    )
    return orders.select("o_orderkey", day.alias("date"), content.alias("content"))


def _day_report(spark, sf_dir):
    files, day = _day_files(spark, sf_dir), F.to_date("o_orderdate")
    span = table(spark, sf_dir, "orders").agg(F.date_sub(F.min(day), 40).alias("a"), F.date_add(F.max(day), 40).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("file_date"))
    return quality.expected_days(days, quality.day_report(quality.games_of_day_files(files)))


@query(
    "validation_split",
    """WITH g AS (SELECT o_orderkey, CAST(n AS BIGINT) AS game_index, n = 0 OR o_custkey % 5 <> 0 AS valid
        FROM orders, (VALUES (0), (1)) AS copies(n)
        WHERE NOT (o_orderkey % 17 = 0 AND day(o_orderdate) % 3 = 0) AND o_orderkey % 11 <> 0)
    SELECT * FROM g""",
)
def validation_split(spark, sf_dir):
    """Every readable game with its place in its file, told apart by whether it is valid."""
    split = quality.split_valid(quality.games_of_day_files(_day_files(spark, sf_dir)))
    return split.select("o_orderkey", "game_index", "valid")


@query(
    "validation_by_day",
    f"WITH {_FILES_SQL} SELECT {day_sql('file_date')} AS file_date, status, games_count, valid_games_count FROM report",
)
def validation_by_day(spark, sf_dir):
    return _day_report(spark, sf_dir)


@query(
    "validation_by_month",
    f"""WITH {_FILES_SQL}
    SELECT strftime(file_date, '%Y-%m') AS month, CAST(sum(games_count) AS BIGINT) AS total_games,
           CAST(sum(valid_games_count) AS BIGINT) AS total_valid_games,
           count(*) FILTER (status <> 'missing' AND (status <> 'validated' OR valid_games_count < games_count))
               AS days_with_errors,
           count(*) FILTER (status = 'missing') AS days_missing
    FROM report GROUP BY 1""",
)
def validation_by_month(spark, sf_dir):
    return quality.month_report(_day_report(spark, sf_dir))


# Runs: one per event.

_RUNS_SQL = """runs AS (
    SELECT user_id, CAST(hour(ts) AS BIGINT) AS hour, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING'
           ELSE 'SUCCEEDED' END AS status FROM events)"""


def _runs(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "view", "RUNNING").otherwise("SUCCEEDED")
    return table(spark, sf_dir, "events").select("user_id", F.hour("ts").alias("hour"), status.alias("status"))


@query(
    "status_rollup",
    f"""WITH {_RUNS_SQL}
    SELECT user_id, hour, bool_and(status = 'SUCCEEDED') AS success, count(*) AS runs,
           count(*) FILTER (status = 'SUCCEEDED') AS succeeded, count(*) FILTER (status <> 'SUCCEEDED') AS not_succeeded
    FROM runs GROUP BY 1, 2""",
)
def status_rollup(spark, sf_dir):
    return runs.status_rollup(_runs(spark, sf_dir), "user_id", "hour")


@query("status_counts", f"WITH {_RUNS_SQL} SELECT status, count(*) AS runs FROM runs GROUP BY 1")
def status_counts(spark, sf_dir):
    return runs.status_counts(_runs(spark, sf_dir))


@query(
    "run_summary",
    f"""WITH d AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(o_orderdate AS DATE) AS date,
                          bool_and(o_orderstatus <> 'F') AS success FROM orders GROUP BY ALL)
    SELECT o_orderpriority, year, count(*) AS total_dates, count(*) FILTER (success) AS success_count,
           bool_and(success) AS all_succeeded,
           coalesce(string_agg({day_sql("date")}, '|' ORDER BY date) FILTER (NOT success), '') AS failed_dates
    FROM d GROUP BY 1, 2""",
)
def run_summary(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_orderstatus") != "F").alias("success"),
    )
    return runs.run_summary(days, "o_orderpriority", "year")


def _spent_sql(start: str, stop: str) -> str:
    seconds = f"((epoch_us({stop}) - epoch_us({start})) // 1000000)"
    return f"CAST({seconds} // 60 AS VARCHAR) || 'm ' || CAST({seconds} % 60 AS VARCHAR) || 's'"


@query(
    "state_durations",
    f"""WITH log AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS state, event_id, ts, event_type
                     FROM events),
    m AS (SELECT user_id, state, max(event_id) FILTER (event_type = 'signup') AS e,
                 max(event_id) FILTER (event_type = 'purchase') AS x, max(event_id) FILTER (event_type = 'error') AS f
          FROM log GROUP BY 1, 2),
    t AS (SELECT m.user_id, m.state, a.ts AS entered_at, b.ts AS exited_at, c.ts AS failed_at FROM m
          JOIN events a ON a.event_id = m.e LEFT JOIN events b ON b.event_id = m.x AND m.x > m.e
          LEFT JOIN events c ON c.event_id = m.f AND m.f > m.e)
    SELECT user_id AS run_id, state, {stamp_sql("entered_at")} AS entered_at, {stamp_sql("exited_at")} AS exited_at,
           {stamp_sql("failed_at")} AS failed_at,
           CASE WHEN exited_at IS NOT NULL THEN 'COMPLETED' WHEN failed_at IS NOT NULL THEN 'FAILED'
                ELSE 'UNKNOWN' END AS status,
           coalesce({_spent_sql("entered_at", "coalesce(exited_at, failed_at)")}, 'N/A') AS duration FROM t""",
)
def state_durations(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        (F.get_json_object("props", "$.k").cast("bigint") % 3).alias("state"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("type"),
    )
    return runs.state_durations(log, entered="signup", exited="purchase", failed="error")


_CHAIN_KINDS = "('signup', 'purchase', 'error')"


@query(
    "state_chain",
    f"""WITH RECURSIVE chain AS (
        SELECT user_id, event_id, ts, event_type, props, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS state,
               lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS prev
        FROM events WHERE event_type IN {_CHAIN_KINDS}),
    walk(user_id, event_id, owner) AS (
        SELECT user_id, event_id, event_id FROM chain WHERE event_type = 'signup'
        UNION ALL
        SELECT c.user_id, c.event_id, w.owner FROM walk w JOIN chain c ON c.user_id = w.user_id AND c.prev = w.event_id
        WHERE c.event_type <> 'signup'),
    marks AS (
        SELECT c.user_id, w.owner, max(c.event_id) FILTER (c.event_type = 'purchase') AS x,
               max(c.event_id) FILTER (c.event_type = 'error') AS f, count(*) AS n
        FROM walk w JOIN chain c ON c.event_id = w.event_id WHERE c.event_type <> 'signup' GROUP BY 1, 2)
    SELECT e.user_id AS run_id, e.state, e.event_id AS entered_id, {stamp_sql("e.ts")} AS entered_at,
           {stamp_sql("x.ts")} AS exited_at, {stamp_sql("f.ts")} AS failed_at,
           CASE WHEN x.ts IS NOT NULL THEN 'COMPLETED' WHEN f.ts IS NOT NULL THEN 'FAILED' ELSE 'UNKNOWN' END AS status,
           coalesce({_spent_sql("e.ts", "coalesce(x.ts, f.ts)")}, 'N/A') AS duration,
           f.event_type AS error, f.props AS cause, coalesce(m.n, 0) AS events
    FROM chain e LEFT JOIN marks m ON m.user_id = e.user_id AND m.owner = e.event_id
    LEFT JOIN chain x ON x.event_id = m.x LEFT JOIN chain f ON f.event_id = m.f
    WHERE e.event_type = 'signup'""",
)
def state_chain(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase", "error"))
    log = events.select(
        F.col("user_id").alias("run_id"),
        (F.get_json_object("props", "$.k").cast("bigint") % 3).alias("state"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("type"),
        F.col("event_type").alias("error"),
        F.col("props").alias("cause"),
    )
    log = chains.previous_in_run(log, "run_id", "id")
    return chains.state_chain(log, entered="signup", exited="purchase", failed="error")


_NOW = "2024-02-01 00:00:00"
_STOP = "CASE WHEN event_type <> 'error' THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END"


@query(
    "run_listing",
    f"""WITH r AS (SELECT event_id, event_type, ts, {_STOP} AS stop,
                          repeat(props, 1 + CAST(user_id % 20 AS INTEGER)) AS cause FROM events)
    SELECT event_id AS run_id, event_type AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started,
           {_spent_sql("ts", f"coalesce(stop, TIMESTAMP '{_NOW}')")} AS duration,
           CASE WHEN length(cause) > 100 THEN substr(cause, 1, 100) || '...' ELSE cause END AS cause FROM r""",
)
def run_listing(spark, sf_dir):
    micros = F.round(F.col("value") * 1000000).cast("bigint")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_type") != "error", F.timestamp_add("MICROSECOND", micros, "ts")).alias("stopped_at"),
        F.repeat("props", (1 + F.col("user_id") % 20).cast("int")).alias("cause"),
    )
    return runs.run_listing(events, _NOW)
