"""Queries on merges, ledgers, date ranges and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import text
from touchline.operators import dates, ledger, merge
from touchline.plans.registry import day_sql, query, stamp_sql
from touchline.plans.tables import contests, contests_sql, table

# Merges.

_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = (
    "l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
_LINE_COLUMNS = (
    "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    f"l_discount, l_tax, l_returnflag, l_linestatus, {stamp_sql('l_shipdate')} AS l_shipdate"
)
_LATEST_SQL = f"""SELECT {_LINE_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) t
    WHERE rn = 1"""


@query("keep_latest", _LATEST_SQL)
def keep_latest(spark, sf_dir):
    return merge.keep_latest(table(spark, sf_dir, "lineitem"), _LINE_KEY, "l_shipdate")


@query("upsert_latest", _LATEST_SQL)
def upsert_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    existing, incoming = lines.where("l_linestatus = 'F'"), lines.where("l_linestatus <> 'F'")
    return merge.upsert_latest(existing, incoming, _LINE_KEY, "l_shipdate")


@query(
    "dedup_subset",
    f"""WITH {contests_sql("home_team", "away_team", "venue")}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY game_date, venue, home_team, away_team
            ORDER BY l_orderkey, l_linenumber, home_score, away_score) AS rn FROM contests)
    SELECT {day_sql("game_date")} AS game_date, venue, home_team, away_team, home_score, away_score, l_orderkey,
           l_linenumber FROM ranked WHERE rn = 1""",
)
def dedup_subset(spark, sf_dir):
    games = contests(spark, sf_dir, "home_team", "away_team", "venue")
    key = ["game_date", "venue", "home_team", "away_team", "time"]
    first = merge.keep_first(games, key, ["l_orderkey", "l_linenumber", "home_score", "away_score"])
    return first.orderBy(F.asc_nulls_last("game_date"), F.asc_nulls_last("venue"))


# Ledgers.

_UPDATES_SQL = """updates AS (
    SELECT CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
           CAST(floor(o_totalprice) AS BIGINT) % 10 AS games_count,
           CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS ts, o_orderkey % 5 = 0 AS force,
           CASE WHEN o_orderkey % 3 = 0 THEN 'v' || CAST(o_orderkey % 100 AS VARCHAR) END AS version,
           o_orderpriority AS dataset FROM orders)"""


def _updates(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
        (F.floor("o_totalprice") % 10).alias("games_count"),
        F.timestamp_add("SECOND", key % 86400, "o_orderdate").alias("ts"),
        (key % 5 == 0).alias("force"),
        F.when(key % 3 == 0, F.concat(F.lit("v"), (key % 100).cast("string"))).alias("version"),
        F.col("o_orderpriority").alias("dataset"),
    )


@query(
    "ledger_first_wins",
    f"""WITH {_UPDATES_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ts DESC, status DESC,
        games_count DESC) AS rn FROM updates WHERE force),
    u AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ts, status, games_count) AS rn FROM updates
        WHERE date NOT IN (SELECT date FROM f))
    SELECT {day_sql("date")} AS date, status, games_count, {stamp_sql("ts")} AS ts FROM f WHERE rn = 1
    UNION ALL SELECT {day_sql("date")}, status, games_count, {stamp_sql("ts")} FROM u WHERE rn = 1""",
)
def ledger_first_wins(spark, sf_dir):
    return ledger.first_write_wins(_updates(spark, sf_dir))


@query(
    "ledger_last_wins",
    f"""WITH {_UPDATES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ts DESC, status DESC,
        games_count DESC) AS rn FROM updates)
    SELECT {day_sql("date")} AS date, status, games_count, {stamp_sql("ts")} AS ts FROM r WHERE rn = 1""",
)
def ledger_last_wins(spark, sf_dir):
    updates = _updates(spark, sf_dir).select("date", "status", "games_count", "ts")
    return ledger.last_write_wins(updates, ["date"])


@query(
    "conversion_status",
    f"""WITH {_UPDATES_SQL}
    SELECT dataset, (SELECT status FROM updates i WHERE i.dataset = u.dataset ORDER BY ts DESC, status DESC LIMIT 1)
               AS status,
           (SELECT version FROM updates i WHERE i.dataset = u.dataset AND version IS NOT NULL
            ORDER BY ts DESC, version DESC LIMIT 1) AS version, {stamp_sql("max(ts)")} AS last_updated
    FROM updates u GROUP BY dataset""",
)
def conversion_status(spark, sf_dir):
    return ledger.conversion_status(_updates(spark, sf_dir), ["dataset"])


# Dates whose day number passes a rule are recorded as done, so gaps exist at every scale.
_STAGES_SQL = """ledger AS (
    SELECT 'scraping' AS stage, CAST(o_orderdate AS DATE) AS date,
           CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status FROM orders
    UNION ALL SELECT 'processing', CAST(l_shipdate AS DATE),
           CASE WHEN day(l_shipdate) % 4 = 0 THEN 'failed' ELSE 'success' END FROM lineitem)"""


def _stages(spark, sf_dir):
    scraped = _updates(spark, sf_dir).select(F.lit("scraping").alias("stage"), "date", "status")
    bad_day = F.dayofmonth("l_shipdate") % 4 == 0
    processed = table(spark, sf_dir, "lineitem").select(
        F.lit("processing").alias("stage"),
        F.to_date("l_shipdate").alias("date"),
        F.when(bad_day, "failed").otherwise("success").alias("status"),
    )
    return scraped.unionByName(processed)


@query(
    "unprocessed_dates",
    f"""WITH {_STAGES_SQL}
    SELECT DISTINCT {day_sql("date")} AS date FROM ledger WHERE stage = 'scraping' AND status = 'success'
      AND date NOT IN (SELECT date FROM ledger WHERE stage = 'processing' AND status = 'success')""",
)
def unprocessed_dates(spark, sf_dir):
    return ledger.unprocessed_dates(_stages(spark, sf_dir))


@query(
    "skip_done",
    f"""WITH {_STAGES_SQL}
    SELECT o_orderkey, {day_sql("o_orderdate")} AS date FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN
        (SELECT date FROM ledger WHERE stage = 'processing' AND status = 'success')""",
)
def skip_done(spark, sf_dir):
    inputs = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return ledger.skip_done(inputs, _stages(spark, sf_dir), "processing")


@query(
    "ledger_summary",
    f"""WITH {_STAGES_SQL}, d AS (SELECT DISTINCT stage, date FROM ledger WHERE status = 'success')
    SELECT stage, count(*) AS total_dates, string_agg({day_sql("date")}, '|' ORDER BY date) AS completed_dates
    FROM d GROUP BY stage""",
)
def ledger_summary(spark, sf_dir):
    return ledger.ledger_summary(_stages(spark, sf_dir), "stage")


_ENTRY = "struct<status:string, games_count:bigint, timestamp:string>"


@query(
    "ledger_rows",
    f"""SELECT o_orderkey, {day_sql("o_orderdate")} AS date, o_orderstatus <> 'P' AS success,
           CAST(floor(o_totalprice) AS BIGINT) % 10 AS games_count, {day_sql("o_orderdate")} AS timestamp FROM orders
    UNION ALL SELECT o_orderkey, {day_sql("o_orderdate + INTERVAL 1 DAY")}, FALSE, 0, NULL FROM orders""",
)
def ledger_rows(spark, sf_dir):
    day = F.to_date("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success")
    entry = F.struct(
        status.alias("status"),
        (F.floor("o_totalprice") % 10).alias("games_count"),
        day.cast("string").alias("timestamp"),
    ).cast(_ENTRY)
    other = F.struct(F.lit("failed"), F.lit(None), F.lit(None)).cast(_ENTRY)
    completed = F.create_map(day.cast("string"), entry, F.date_add(day, 1).cast("string"), other)
    documents = table(spark, sf_dir, "orders").select("o_orderkey", completed.alias("completed_dates"))
    return ledger.rows_from_map(documents, "completed_dates", "o_orderkey")


@query(
    "ledger_map",
    f"""WITH r AS (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, max(CAST(o_orderkey AS VARCHAR)) AS timestamp
        FROM orders GROUP BY ALL),
    e AS (SELECT r.o_custkey, r.date, o_orderstatus <> 'P' AS success,
                 CAST(floor(o_totalprice) AS BIGINT) % 10 AS games_count
          FROM r JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = r.timestamp)
    SELECT o_custkey, count(*) AS dates, string_agg({day_sql("date")} || '='
           || CASE WHEN success THEN 'success' ELSE 'failed' END || ':' || CAST(games_count AS VARCHAR), '|'
           ORDER BY date) AS entries
    FROM e GROUP BY o_custkey""",
)
def ledger_map(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_orderstatus") != "P").alias("success"),
        (F.floor("o_totalprice") % 10).alias("games_count"),
        F.col("o_orderkey").cast("string").alias("timestamp"),
    )
    maps = ledger.map_from_rows(rows, "o_custkey")
    entry = lambda e: F.concat(
        e["key"].cast("string"), F.lit("="), e["value"]["status"], F.lit(":"), e["value"]["games_count"].cast("string")
    )
    entries = F.transform(F.map_entries("completed_dates"), entry)
    return maps.select("o_custkey", F.size("completed_dates").alias("dates"), entries.alias("entries"))


@query(
    "backfill_status",
    """WITH k AS (
        SELECT o_custkey, CASE WHEN o_orderkey % 23 = 0 THEN 'backfill_completed.marker'
            WHEN o_orderkey % 11 = 0 THEN 'backfill_in_progress.marker'
            WHEN o_custkey % 4 = 0 THEN 'readme.txt' ELSE 'games.jsonl' END AS name FROM orders),
    f AS (SELECT o_custkey, count(*) FILTER (name = 'games.jsonl') AS files_count,
                 bool_or(name = 'backfill_in_progress.marker') AS in_progress_marker,
                 bool_or(name = 'backfill_completed.marker') AS completed_marker FROM k GROUP BY 1)
    SELECT *, CASE WHEN completed_marker THEN 'COMPLETED' WHEN in_progress_marker THEN 'IN_PROGRESS'
                   WHEN files_count > 0 THEN 'COMPLETED' ELSE 'NOT_STARTED' END AS status FROM f""",
)
def backfill_status(spark, sf_dir):
    key = F.col("o_orderkey")
    name = (
        F.when(key % 23 == 0, "backfill_completed.marker")
        .when(key % 11 == 0, "backfill_in_progress.marker")
        .when(F.col("o_custkey") % 4 == 0, "readme.txt")
        .otherwise("games.jsonl")
    )
    path = F.concat(F.lit("feed/"), F.col("o_custkey").cast("string"), F.lit("/"), name)
    return ledger.backfill_status(table(spark, sf_dir, "orders").select("o_custkey", path.alias("key")), "o_custkey")


# Date ranges: one range per order, from its date onwards.


def _ranges(spark, sf_dir, length: int):
    start = F.to_date("o_orderdate")
    days = (F.col("o_orderkey") % length).cast("int")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", start.alias("start_date"), F.date_add(start, days).alias("end_date")
    )


def _ranges_sql(length: int) -> str:
    return f"""ranges AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % {length} AS INTEGER) AS end_date FROM orders)"""


def _spine_sql(length: int) -> str:
    return f"""{_ranges_sql(length)}, spine AS (SELECT o_orderkey, start_date, end_date,
        CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM ranges)"""


@query("date_spine", f"WITH {_spine_sql(10)} SELECT o_orderkey, {day_sql('date')} AS date FROM spine")
def date_spine(spark, sf_dir):
    return dates.date_spine(_ranges(spark, sf_dir, 10)).select("o_orderkey", "date")


def _batches_sql(length: int, size: str) -> str:
    return f"""{_ranges_sql(length)}, b AS (
        SELECT *, unnest(generate_series(0, datediff('day', start_date, end_date), {size})) AS skip FROM ranges),
    batches AS (SELECT o_orderkey, start_date, end_date, start_date + CAST(skip AS INTEGER) AS batch_start,
                       least(start_date + CAST(skip + {size} - 1 AS INTEGER), end_date) AS batch_end FROM b)"""


@query(
    "date_batches",
    f"""WITH {_batches_sql(40, "3")}
    SELECT o_orderkey, {day_sql("batch_start")} AS batch_start, {day_sql("batch_end")} AS batch_end,
           datediff('day', batch_start, batch_end) + 1 AS days FROM batches""",
)
def date_batches(spark, sf_dir):
    batches = dates.date_batches(_ranges(spark, sf_dir, 40))
    return batches.select("o_orderkey", "batch_start", "batch_end", "days")


@query(
    "range_chunks",
    f"""WITH {_batches_sql(400, "90")}
    SELECT o_orderkey, {day_sql("batch_start")} AS batch_start, {day_sql("batch_end")} AS batch_end,
           datediff('day', batch_start, batch_end) + 1 AS days,
           datediff('day', start_date, end_date) + 1 > 90 AS split_required FROM batches""",
)
def range_chunks(spark, sf_dir):
    chunks = dates.range_chunks(_ranges(spark, sf_dir, 400))
    return chunks.select("o_orderkey", "batch_start", "batch_end", "days", "split_required")


@query(
    "range_requests",
    f"""WITH r AS (SELECT o_orderkey,
            CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN '01/02/2024'
                 ELSE {day_sql("o_orderdate")} END AS s,
            CASE WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN '2024-02-30'
                 ELSE {day_sql("o_orderdate + to_days(CAST(o_orderkey % 9 - 2 AS INTEGER))")} END AS e,
            CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 15 - 2 END AS n,
            CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 2 = 0 END AS f FROM orders),
    p AS (SELECT *, CASE WHEN s LIKE '____-__-__' THEN TRY_CAST(s AS DATE) END AS sd,
                 CASE WHEN e LIKE '____-__-__' THEN TRY_CAST(e AS DATE) END AS ed FROM r)
    SELECT o_orderkey, {day_sql("sd")} AS start_date, {day_sql("ed")} AS end_date,
           greatest(1, least(10, coalesce(n, 3))) AS batch_size, coalesce(f, FALSE) AS force,
           CASE WHEN coalesce(s, '') = '' OR coalesce(e, '') = '' THEN 'missing date'
                WHEN sd IS NULL OR ed IS NULL THEN 'invalid date format'
                WHEN sd > ed THEN 'start after end' END AS error FROM p""",
)
def range_requests(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    shifted = F.date_add(day, (key % 9 - 2).cast("int")).cast("string")
    requests = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 13 == 0, None).when(key % 17 == 0, "01/02/2024").otherwise(day.cast("string")).alias("start_date"),
        F.when(key % 19 == 0, "").when(key % 23 == 0, "2024-02-30").otherwise(shifted).alias("end_date"),
        F.when(key % 7 != 0, key % 15 - 2).alias("batch_size"),
        F.when(key % 5 > 0, key % 2 == 0).alias("force"),
    )
    return dates.range_requests(requests)


@query(
    "trailing_days",
    f"""SELECT event_id, {stamp_sql("ts")} AS ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-21'""",
)
def trailing_days(spark, sf_dir):
    return dates.trailing_days(table(spark, sf_dir, "events"), "ts", "2024-01-20").select("event_id", "ts")


@query(
    "period_bounds",
    f"""SELECT o_orderkey, {day_sql("o_orderdate")} AS start_date,
           CASE o_orderkey % 3 WHEN 0 THEN {day_sql("o_orderdate")} WHEN 1 THEN {day_sql("o_orderdate + INTERVAL 6 DAY")}
                ELSE {day_sql("last_day(o_orderdate)")} END AS end_date FROM orders""",
)
def period_bounds(spark, sf_dir):
    key, start = F.col("o_orderkey"), F.to_date("o_orderdate")
    mode = F.when(key % 3 == 0, "day").when(key % 3 == 1, "week").otherwise("month")
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", start.alias("start_date"), dates.period_end(mode, start).alias("end_date"))


@query(
    "month_spine",
    f"""WITH {_ranges_sql(400)}, m AS (SELECT o_orderkey, unnest(generate_series(date_trunc('month', start_date),
        CAST(end_date AS TIMESTAMP), INTERVAL 1 MONTH)) AS month_start FROM ranges)
    SELECT o_orderkey, {day_sql("month_start")} AS month_start FROM m""",
)
def month_spine(spark, sf_dir):
    return dates.month_spine(_ranges(spark, sf_dir, 400)).select("o_orderkey", "month_start")


@query(
    "month_days",
    f"""WITH d AS (SELECT o_orderkey, CAST(unnest(generate_series(date_trunc('month', o_orderdate),
            CAST(last_day(o_orderdate) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
    SELECT o_orderkey, {day_sql("date")} AS date FROM d
    WHERE o_orderkey % 20 = 0 OR day(date) IN (o_orderkey % 35, 15, 31)""",
)
def month_days(spark, sf_dir):
    key = F.col("o_orderkey")
    wanted = F.when(key % 20 != 0, F.array((key % 35).cast("int"), F.lit(15), F.lit(31)))
    requests = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("month_start"), wanted.alias("target_days")
    )
    return dates.month_days(requests).select("o_orderkey", "date")


@query(
    "partition_path",
    "SELECT o_orderkey, strftime(o_orderdate, 'year=%Y/month=%m/day=%d') AS path FROM orders",
)
def partition_path(spark, sf_dir):
    path = text.partition_path(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))


# A day is present when an urgent order was placed on it, all orders read; the same days make gap_ranges.
_PRESENT_SQL = "present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT')"


def _present(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return orders.select(F.to_date("o_orderdate").alias("date"))


@query(
    "missing_dates",
    f"""WITH {_spine_sql(10)}, {_PRESENT_SQL}
    SELECT o_orderkey, {day_sql("date")} AS date FROM spine WHERE date NOT IN (SELECT date FROM present)""",
)
def missing_dates(spark, sf_dir):
    missing = dates.missing_dates(_ranges(spark, sf_dir, 10), _present(spark, sf_dir))
    return missing.select("o_orderkey", "date")


_COVERAGE = f"""count(*) AS total_days, count(*) FILTER (present) AS processed_days,
    count(*) FILTER (NOT present) AS missing_count, bool_and(present) AS success,
    coalesce(string_agg({day_sql("date")}, '|' ORDER BY date) FILTER (NOT present), '') AS missing_days"""


@query(
    "gap_ranges",
    f"""WITH {_spine_sql(10)},
    urgent AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT'),
    miss AS (SELECT o_orderkey, date FROM spine WHERE date NOT IN (SELECT date FROM urgent)),
    isl AS (SELECT o_orderkey, date, date - CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY date) AS INTEGER) AS island
            FROM miss)
    SELECT o_orderkey, {day_sql("min(date)")} AS gap_start, {day_sql("max(date)")} AS gap_end, count(*) AS days
    FROM isl GROUP BY o_orderkey, island""",
)
def gap_ranges(spark, sf_dir):
    """Runs of days without an urgent order inside each order's range, all orders read."""
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.to_date("o_orderdate").alias("date"))
    return dates.gap_ranges(_ranges(spark, sf_dir, 10), urgent, "o_orderkey")


@query(
    "coverage_summary",
    f"""WITH {_spine_sql(10)}, {_PRESENT_SQL},
    c AS (SELECT o_orderkey, date, date IN (SELECT date FROM present) AS present FROM spine)
    SELECT o_orderkey, {_COVERAGE} FROM c GROUP BY o_orderkey""",
)
def coverage_summary(spark, sf_dir):
    return dates.coverage_summary(_ranges(spark, sf_dir, 10), _present(spark, sf_dir), ["o_orderkey"])


@query(
    "verify_results",
    f"""WITH {_spine_sql(10)}, {_PRESENT_SQL},
    c AS (SELECT o_orderkey, date, CASE WHEN o_orderkey % 3 = 0 THEN date IN (SELECT date FROM present)
                                        ELSE day(date) % 4 <> 0 OR (o_orderkey % 3 = 1 AND day(date) % 8 = 4) END AS present
          FROM spine)
    SELECT o_orderkey, {_COVERAGE} FROM c GROUP BY o_orderkey""",
)
def verify_results(spark, sf_dir):
    ranges = _ranges(spark, sf_dir, 10)
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    first = F.transform(days, lambda d: F.struct(d, F.dayofmonth(d) % 4 != 0))
    again = F.transform(F.filter(days, lambda d: F.dayofmonth(d) % 4 == 0), lambda d: F.struct(d, F.dayofmonth(d) % 8 == 4))
    run = lambda rest, found: ranges.where(rest).select("o_orderkey", F.map_from_entries(found).alias("results"))
    # Some batches are tried twice; the second try covers the days that failed.
    results = run(F.col("o_orderkey") % 3 != 0, first).unionByName(run(F.col("o_orderkey") % 3 == 1, again))
    return dates.verify_results(ranges, results, _present(spark, sf_dir), ["o_orderkey"])


_BASE_URL, _FACILITY = "https://pages.example.org/print", "12"
_DAY_TEXT = "CAST(month({0}) AS VARCHAR) || '/' || CAST(day({0}) AS VARCHAR) || '/' || CAST(year({0}) AS VARCHAR)"


def _url_sql(date: str) -> str:
    title = f"'Games on ' || strftime({date}, '%A, %B %d, %Y')"
    return (
        f"'{_BASE_URL}?type=schedule&title=' || replace(url_encode({title}), '%20', '+') || '&team_id=0&league_id=0"
        f"&facility_id={_FACILITY}&day=' || url_encode({_DAY_TEXT.format(date)}) || '&framed=1'"
    )


@query(
    "frontier_urls",
    f"SELECT o_orderkey, {_url_sql('CAST(o_orderdate AS DATE)')} AS url FROM orders",
)
def frontier_urls(spark, sf_dir):
    url = text.page_address(F.to_date("o_orderdate"), _BASE_URL, _FACILITY)
    return table(spark, sf_dir, "orders").select("o_orderkey", url.alias("url"))


@query(
    "frontier",
    f"""WITH {_spine_sql(10)}, {_STAGES_SQL}, todo AS (
        SELECT DISTINCT date FROM spine WHERE date NOT IN
            (SELECT date FROM ledger WHERE stage = 'processing' AND status = 'success'))
    SELECT {day_sql("date")} AS date, {_url_sql("date")} AS url FROM todo""",
)
def frontier(spark, sf_dir):
    ranges, done = _ranges(spark, sf_dir, 10), _stages(spark, sf_dir)
    return dates.frontier(ranges, done, _BASE_URL, _FACILITY, "processing")
