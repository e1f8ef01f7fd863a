"""Queries that scan, select and write files.

Those with a sink write the whole derived table to the shared scratch folder,
read it back and answer from what was stored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.plans.registry import day_sql, query, stamp_sql
from touchline.plans.tables import RUN_TS, contests, contests_sql, table
from touchline.schema import CANONICAL
from touchline.sources import files, sinks
from touchline.sources.scratch import scratch_dir, staged

_LINE_DDL = "l_orderkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"


@query(
    "scan_parquet",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, {stamp_sql("l_shipdate")} AS l_shipdate
    FROM lineitem WHERE l_quantity > 45""",
)
def scan_parquet(spark, sf_dir):
    found = files.scan_table(spark, f"{sf_dir}/lineitem.parquet", _LINE_DDL)
    absent = files.scan_table(spark, f"{sf_dir}/no_such_table.parquet", _LINE_DDL)
    return found.where(F.col("l_quantity") > 45).unionByName(absent)


_GAME_TABLE_SQL = """SELECT l_orderkey, 'Side ' || CAST(l_suppkey % 40 AS VARCHAR) AS home_team,
    'Side ' || CAST(l_partkey % 40 AS VARCHAR) AS away_team, l_quantity AS amount,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS home_score,
    'a "quoted", line' AS note, l_shipdate AS played FROM lineitem"""
_GAME_TABLE = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("home_score", T.LongType()),
        T.StructField("note", T.StringType()),
        T.StructField("played", T.TimestampNTZType()),
    ]
)
_GAME_ROWS = f"SELECT * REPLACE ({stamp_sql('played')} AS played) FROM ({_GAME_TABLE_SQL}) g"


def _game_table(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("Side "), (F.col("l_suppkey") % 40).cast("string")).alias("home_team"),
        F.concat(F.lit("Side "), (F.col("l_partkey") % 40).cast("string")).alias("away_team"),
        F.col("l_quantity").alias("amount"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("bigint")).alias("home_score"),
        F.lit('a "quoted", line').alias("note"),
        F.col("l_shipdate").alias("played"),
    )


@query("parquet_roundtrip", _GAME_ROWS)
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "parquet")
    sinks.write_parquet(_game_table(spark, sf_dir), path, _GAME_TABLE)
    return files.scan_table(spark, path, _GAME_TABLE)


@query("csv_roundtrip", _GAME_ROWS)
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    sinks.write_csv(_game_table(spark, sf_dir), path)
    return sinks.read_csv(spark, path, _GAME_TABLE)


def _stored_json(spark, sf_dir):
    path = scratch_dir(spark, "json")
    sinks.write_day_json(_game_table(spark, sf_dir), path, "played", ("year", "month"))
    stored = T.StructType([*_GAME_TABLE, T.StructField("year", T.LongType()), T.StructField("month", T.LongType())])
    return files.scan_partitioned_json(spark, path, stored)


_JSON_ROWS = f"""SELECT * REPLACE ({stamp_sql("played")} AS played), CAST(year(played) AS BIGINT) AS year,
    CAST(month(played) AS BIGINT) AS month FROM ({_GAME_TABLE_SQL}) g"""


@query("json_roundtrip", _JSON_ROWS)
def json_roundtrip(spark, sf_dir):
    return _stored_json(spark, sf_dir)


@query("partition_scan", f"{_JSON_ROWS} WHERE year(g.played) = 1997 AND month(g.played) = 3")
def partition_scan(spark, sf_dir):
    return _stored_json(spark, sf_dir).where("year = 1997 AND month = 3")


def _array_lines(batches):
    """Each task's JSON rows as the lines of one array."""
    opened = False
    for batch in batches:
        rows = batch.column(0).to_pylist()
        lines = [("," if opened or i else "[") + row for i, row in enumerate(rows)]
        opened = opened or bool(rows)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    if opened:
        yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], names=["value"])


def _json_feed(spark, sf_dir, damaged=False):
    """Files of lines and of indented arrays; if ``damaged``, with broken lines between good ones and broken documents."""
    path = scratch_dir(spark, "feed")
    events = table(spark, sf_dir, "events").drop("props")
    events = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    row = F.to_json(F.struct("*"))
    if damaged:
        row = F.when(F.col("event_id") % 7 == 3, F.concat(F.lit("x"), row)).otherwise(row)
    as_lines = F.col("event_type").isin("view", "click")
    events.where(as_lines).select(row.alias("value")).write.text(f"{path}/lines")
    rows = events.where(~as_lines).select(row.alias("value"))
    rows.mapInArrow(_array_lines, "value string").write.text(f"{path}/arrays")
    return path


_EVENT_DDL = "event_id bigint, ts string, user_id bigint, event_type string, value double"


def _any_data(name):
    return ~F.endswith(name, F.lit("meta.json")) & ~F.contains(name, F.lit("_SUCCESS"))


@query(
    "json_lines_or_array",
    f"SELECT event_id, {stamp_sql('ts')} AS ts, user_id, event_type, value FROM events",
)
def json_lines_or_array(spark, sf_dir):
    return files.json_records(spark, _json_feed(spark, sf_dir), _EVENT_DDL, keep=_any_data)


_REJECTED = "event_id % 7 = 3 OR event_type NOT IN ('view', 'click')"


@query(
    "json_rejects",
    f"""SELECT event_id, '{files.NOT_AN_OBJECT}' AS reason FROM events WHERE {_REJECTED}""",
)
def json_rejects(spark, sf_dir):
    """Broken lines of files of lines; every line of the arrays, which no longer parse, for their commas."""
    rejects = files.json_rejects(spark, _json_feed(spark, sf_dir, damaged=True), keep=_any_data)
    numbered = rejects.select(F.regexp_extract("text", r'"event_id":(\d+)', 1).alias("event_id"), "reason")
    return numbered.select(F.col("event_id").try_cast("bigint").alias("event_id"), "reason").where("event_id IS NOT NULL")


# Listings: one file per order, named in several ways.

_LISTING_SQL = """listing AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400)
        AS last_modified, CASE o_orderkey % 5
        WHEN 0 THEN 'feed/' || strftime(o_orderdate, '%Y-%m-%d') || '/games.jsonl'
        WHEN 1 THEN 'feed/year=' || strftime(o_orderdate, '%Y') || '/' || strftime(o_orderdate, '%Y-%m-%d') || '_games.json'
        WHEN 2 THEN 'feed/' || strftime(o_orderdate, '%Y-%m-%d') || '/meta.json'
        WHEN 3 THEN 'feed-of-the-year/' || strftime(o_orderdate, '%Y-%m-%d') || '.html'
        ELSE 'feed/data.json' END AS key FROM orders)"""


def _listing(spark, sf_dir):
    kind, day = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd")
    year = F.date_format("o_orderdate", "yyyy")
    path = (
        F.when(kind == 0, F.concat(F.lit("feed/"), day, F.lit("/games.jsonl")))
        .when(kind == 1, F.concat(F.lit("feed/year="), year, F.lit("/"), day, F.lit("_games.json")))
        .when(kind == 2, F.concat(F.lit("feed/"), day, F.lit("/meta.json")))
        .when(kind == 3, F.concat(F.lit("feed-of-the-year/"), day, F.lit(".html")))
        .otherwise(F.lit("feed/data.json"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, "o_orderdate").alias("last_modified"),
        path.alias("key"),
    )


@query(
    "file_filter",
    f"""WITH {_LISTING_SQL} SELECT o_orderkey, key FROM listing
    WHERE (key LIKE '%.json' OR key LIKE '%.jsonl') AND key NOT LIKE '%meta.json'""",
)
def file_filter(spark, sf_dir):
    return files.data_files(_listing(spark, sf_dir)).select("o_orderkey", "key")


_RUN_LOG_SQL = """log AS (SELECT l_returnflag AS prefix, CASE WHEN l_quantity > 10 THEN 'SUCCESS' ELSE 'ERROR' END AS status,
    l_shipdate - INTERVAL 400 DAY AS finished_at FROM lineitem)"""


def _run_log(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("prefix"),
        F.when(F.col("l_quantity") > 10, "SUCCESS").otherwise("ERROR").alias("status"),
        (F.col("l_shipdate") - F.expr("interval 400 days")).alias("finished_at"),
    )


@query(
    "marker_advance",
    f"""WITH {_RUN_LOG_SQL}
    SELECT prefix, {stamp_sql("max(finished_at) FILTER (status = 'SUCCESS')")} AS marker FROM log GROUP BY prefix""",
)
def marker_advance(spark, sf_dir):
    return files.advance_markers(_run_log(spark, sf_dir), "prefix")


_PREFIXES = ("A", "N", "R", "S")  # the last has no marker


@query(
    "incremental_files",
    f"""WITH {_LISTING_SQL}, {_RUN_LOG_SQL}, marker AS (
        SELECT prefix, max(finished_at) AS marker FROM log WHERE status = 'SUCCESS' GROUP BY prefix),
    named AS (SELECT *, substr('ANRS', CAST(o_orderkey % 4 AS INT) + 1, 1) AS prefix FROM listing)
    SELECT o_orderkey, n.prefix, key, {stamp_sql("last_modified")} AS last_modified FROM named n
    LEFT JOIN marker m ON n.prefix = m.prefix
    WHERE last_modified > coalesce(marker, TIMESTAMP '1998-05-01 12:00:00' - INTERVAL 2 DAY)
      AND (key LIKE '%.json' OR key LIKE '%.jsonl') AND key NOT LIKE '%meta.json'""",
)
def incremental_files(spark, sf_dir):
    markers = files.advance_markers(_run_log(spark, sf_dir), "prefix")
    prefix = F.get(F.lit(list(_PREFIXES)), (F.col("o_orderkey") % 4).cast("int"))
    listing = _listing(spark, sf_dir).withColumn("prefix", prefix)
    recent = files.changed_since(listing, markers, "1998-05-01 12:00:00")
    return files.data_files(recent).select("o_orderkey", "prefix", "key", "last_modified")


@query(
    "path_date_filter",
    f"""WITH {_LISTING_SQL} SELECT o_orderkey, key FROM listing
    WHERE regexp_extract(key, '\\d{{4}}-\\d{{2}}-\\d{{2}}') = ''
       OR regexp_extract(key, '\\d{{4}}-\\d{{2}}-\\d{{2}}') BETWEEN '1996-05-01' AND '1997-02-28'""",
)
def path_date_filter(spark, sf_dir):
    return files.in_path_dates(_listing(spark, sf_dir), "1996-05-01", "1997-02-28").select("o_orderkey", "key")


@query(
    "html_file_select",
    f"""WITH {_LISTING_SQL} SELECT o_orderkey, key, regexp_extract(key, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS file_date
    FROM listing WHERE key LIKE '%.html'
      AND regexp_extract(key, '\\d{{4}}-\\d{{2}}-\\d{{2}}') BETWEEN '1996-05-01' AND '1998-02-28'""",
)
def html_file_select(spark, sf_dir):
    chosen = files.html_day_files(_listing(spark, sf_dir), "1996-05-01", "1998-02-28")
    return chosen.select("o_orderkey", "key", "file_date")


@query(
    "sample_files",
    f"""WITH {_LISTING_SQL}, u AS (SELECT DISTINCT key FROM listing)
    SELECT key FROM u ORDER BY md5(key || '#42'), key LIMIT 50""",
)
def sample_files(spark, sf_dir):
    return files.sample_files(_listing(spark, sf_dir).select("key").distinct(), 50, seed=42)


@query(
    "file_counts",
    f"""WITH {_LISTING_SQL} SELECT split_part(key, '/', 1) AS prefix, strftime(last_modified, '%Y-%m') AS month,
        count(*) AS files FROM listing GROUP BY 1, 2""",
)
def file_counts(spark, sf_dir):
    listing = _listing(spark, sf_dir).select(
        F.split_part("key", F.lit("/"), F.lit(1)).alias("prefix"),
        F.date_format("last_modified", "yyyy-MM").alias("month"),
    )
    return files.file_counts(listing, "prefix", "month")


@query(
    "dry_run_counts",
    "SELECT strftime(l_shipdate, 'year=%Y/month=%m/day=%d') AS target, count(*) AS games FROM lineitem GROUP BY 1",
)
def dry_run_counts(spark, sf_dir):
    return sinks.dry_run(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query(
    "day_metadata",
    f"""WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), max(l_shipdate), INTERVAL 1 DAY))
                   AS DATE) AS date FROM lineitem),
    n AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT {day_sql("d.date")} AS date, coalesce(n, 0) AS games_count, '{RUN_TS}.000000' AS scraped_timestamp
    FROM d LEFT JOIN n ON d.date = n.date""",
)
def day_metadata(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    # The calendar starts with the first order, before the first shipment, so the days without games are real ones.
    none = F.lit(None).cast("date")
    placed = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("a"), none.alias("b"))
    span = placed.unionByName(lines.select(none.alias("a"), F.to_date("l_shipdate").alias("b"))).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    played = lines.select(F.to_date("l_shipdate").alias("date"))
    return sinks.day_metadata(played, days, RUN_TS)


@query(
    "versioned_snapshot",
    """SELECT 'latest' AS snapshot, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL
    UNION ALL SELECT 'backup', l_returnflag, count(*) FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL""",
)
def versioned_snapshot(spark, sf_dir):
    path = scratch_dir(spark, "snapshot")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    sinks.publish_snapshot(lines.where("l_linestatus = 'F'"), path, "2025-03-01")
    sinks.publish_snapshot(lines, path, "2025-03-02")
    latest = sinks.read_snapshot(spark, path).withColumn("snapshot", F.lit("latest"))
    backup = sinks.read_snapshot(spark, path, back=1).withColumn("snapshot", F.lit("backup"))
    return latest.unionByName(backup).groupBy("snapshot", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "consolidate",
    """SELECT id, flag, priority, count(*) AS n FROM (
        SELECT l_orderkey AS id, l_returnflag AS flag, NULL AS priority FROM lineitem
        UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders) t GROUP BY ALL""",
)
def consolidate(spark, sf_dir):
    path = scratch_dir(spark, "parts")
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    lines.select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("flag")).write.parquet(f"{path}/a")
    orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority")).write.parquet(f"{path}/b")
    whole = sinks.consolidate(spark, path)
    return whole.groupBy("id", "flag", "priority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_log",
    f"""SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS status, count(*) AS files,
           CAST(sum(floor(value)) AS BIGINT) AS new_rows, {stamp_sql("max(ts)")} AS finished_at
    FROM events GROUP BY 1, 2""",
)
def run_log(spark, sf_dir):
    path = scratch_dir(spark, "run_log")
    results = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("status"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum(F.floor("value")).alias("new_rows"),
            F.max("ts").alias("finished_at"),
        )
    )
    failed = F.col("status") == "error"
    sinks.append_run_log(results.where(failed), path)
    sinks.append_run_log(results.where(~failed), path)
    return spark.read.parquet(path)


_VALID_SQL = "coalesce(event_type <> 'error', false)"


def _observed(spark, sf_dir, path=None):
    events = table(spark, sf_dir, "events")
    valid = F.col("event_type") != "error"
    return sinks.write_observed(events, path or scratch_dir(spark, "observed"), valid, "value", "ts", "events")


@query(
    "observed_run_log",
    f"""SELECT 'events' AS run_id, count(*) FILTER ({_VALID_SQL}) AS valid_rows,
           count(*) FILTER (NOT {_VALID_SQL}) AS rejected_rows,
           CAST(sum(floor(value)) FILTER ({_VALID_SQL}) AS BIGINT) AS new_rows, {stamp_sql("max(ts)")} AS finished_at
    FROM events""",
)
def observed_run_log(spark, sf_dir):
    """Counts of a write of valid and rejected events, observed while writing; the file count is left to the file rows."""
    log, _ = _observed(spark, sf_dir)
    return log.drop("files")


@query(
    "observed_run_files",
    f"""SELECT CASE WHEN {_VALID_SQL} THEN 'valid' ELSE 'rejected' END AS kind, count(*) AS rows
    FROM events GROUP BY 1""",
)
def observed_run_files(spark, sf_dir):
    """Rows read back, per kind, from exactly the files that the listing of the observed write names."""
    path = scratch_dir(spark, "observed")
    _, files = _observed(spark, sf_dir, path)
    written = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"))
    back = written.join(files, "file")
    return back.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "staged_build",
    f"""WITH {contests_sql("league")}
    SELECT league, count(*) AS days, max(n) AS most FROM (
        SELECT league, game_date, count(*) AS n FROM contests GROUP BY ALL) d GROUP BY league""",
)
def staged_build(spark, sf_dir):
    per_day = contests(spark, sf_dir, "league").groupBy("league", "game_date").agg(F.count(F.lit(1)).alias("n"))
    kept = staged(per_day, "per_day")
    return kept.groupBy("league").agg(F.count(F.lit(1)).alias("days"), F.max("n").alias("most"))


_KINDS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "describe_table",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS filled FROM orders"
        for i, (c, t) in enumerate(_KINDS.items())
    ),
)
def describe_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    counts = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("ordinal"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(name).alias("filled"),
        )
        for i, (name, kind) in enumerate(orders.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "table_sample",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {stamp_sql('o_orderdate')} AS o_orderdate, o_orderpriority
    FROM orders ORDER BY o_orderkey, o_custkey, o_totalprice LIMIT 10""",
)
def table_sample(spark, sf_dir):
    """The first ten rows in a total order."""
    return table(spark, sf_dir, "orders").orderBy("o_orderkey", "o_custkey", "o_totalprice").limit(10)


_ADHOC = """SELECT league, count(*) AS game_count, round(avg(home_score + away_score), 4) AS avg_total_score
    FROM {games} GROUP BY league HAVING count(*) > 1 ORDER BY avg_total_score DESC"""


@query("adhoc_sql", f"WITH {contests_sql('league')} {_ADHOC.format(games='contests')}")
def adhoc_sql(spark, sf_dir):
    return spark.sql(_ADHOC, games=contests(spark, sf_dir, "league"))


@query(
    "month_table",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY date, home_team, away_team, league
            ORDER BY timestamp DESC, home_score NULLS LAST, away_score NULLS LAST) AS rn FROM (
        SELECT l_shipdate AS date, 'Side ' || CAST(l_suppkey % 9 AS VARCHAR) AS home_team,
               'Side ' || CAST(l_partkey % 9 AS VARCHAR) AS away_team,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS BIGINT) END AS home_score,
               CAST(l_quantity AS BIGINT) AS away_score, l_returnflag AS league,
               l_shipdate + to_seconds(l_orderkey % 86400) AS timestamp FROM lineitem) g)
    SELECT {stamp_sql("date")} AS date, home_team, away_team, home_score, away_score, league,
           {stamp_sql("timestamp")} AS timestamp, strftime(date, '%Y-%m') AS month FROM r WHERE rn = 1""",
)
def month_table(spark, sf_dir):
    """Two batches merged into a table in month folders."""
    path = scratch_dir(spark, "months")
    games = versions(spark, sf_dir)
    first = F.col("timestamp") < F.col("date") + F.expr("interval 6 hours")
    sinks.merge_months(games.where(first), path)
    sinks.merge_months(games.where(~first), path)
    columns = ("date", "home_team", "away_team", "home_score", "away_score", "league", "timestamp", "month")
    return sinks.read_months(spark, path).select(*columns)


def versions(spark, sf_dir):
    """Games in the canonical schema, several versions each."""
    known = {
        "date": F.col("l_shipdate"),
        "home_team": F.concat(F.lit("Side "), (F.col("l_suppkey") % 9).cast("string")),
        "away_team": F.concat(F.lit("Side "), (F.col("l_partkey") % 9).cast("string")),
        "home_score": F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")),
        "away_score": F.col("l_quantity"),
        "league": F.col("l_returnflag"),
        "timestamp": F.timestamp_add("SECOND", F.col("l_orderkey") % 86400, "l_shipdate"),
    }
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL]
    return table(spark, sf_dir, "lineitem").select(*columns)
