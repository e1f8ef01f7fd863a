"""One query per group of scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.functions import text
from touchline.plans.registry import day_sql, query, stamp_sql
from touchline.plans.tables import table


@query(
    "scalar_string",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, split_part(p_name, ' ', 1) AS first_word,
           p_type LIKE 'ECON%' AS starts, p_name LIKE '%ring' AS ends, replace(p_brand, 'Brand#', 'B') AS replaced,
           contains(p_name, 'red') AS has, substr(p_name, 1, 5) AS sliced, lower(p_type) AS lowered,
           printf('%s-%03d', p_brand, p_size) AS formatted, p_name || '/' || p_type AS joined,
           CASE WHEN length(p_name || p_type) > 12 THEN substr(p_name || p_type, 1, 12) || '...'
                ELSE p_name || p_type END AS clipped FROM part""",
)
def scalar_string(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.strip_text(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.split(name, " ")[0].alias("first_word"),
        F.startswith("p_type", F.lit("ECON")).alias("starts"),
        F.endswith("p_name", F.lit("ring")).alias("ends"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("replaced"),
        F.contains("p_name", F.lit("red")).alias("has"),
        F.substring(name, 1, 5).alias("sliced"),
        F.lower("p_type").alias("lowered"),
        F.format_string("%s-%03d", "p_brand", "p_size").alias("formatted"),
        F.concat_ws("/", "p_name", "p_type").alias("joined"),
        text.clip(F.concat("p_name", "p_type"), 12).alias("clipped"),
    )


@query(
    "scalar_regex",
    f"""SELECT page_id, regexp_matches(url, '^https?://') AS web, regexp_extract(url, '/([0-9]+)', 1) AS number,
           regexp_matches(url, '{fixed.SCORE_LIKE}') AS score_like, url LIKE '%example%' AS named FROM pages""",
)
def scalar_regex(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        url.rlike("^https?://").alias("web"),
        F.regexp_extract(url, "/([0-9]+)", 1).alias("number"),
        url.rlike(fixed.SCORE_LIKE).alias("score_like"),
        url.like("%example%").alias("named"),
    )


@query(
    "scalar_date",
    f"""SELECT o_orderkey, {day_sql("o_orderdate")} AS day, strftime(o_orderdate, '%A, %B %d, %Y') AS long_name,
           {day_sql("o_orderdate + INTERVAL 6 DAY")} AS week_end, {day_sql("last_day(o_orderdate)")} AS month_end,
           CAST(day(last_day(o_orderdate)) AS BIGINT) AS month_length, CAST(month(o_orderdate) AS BIGINT) AS month,
           datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age,
           {day_sql("make_date(year(o_orderdate), month(o_orderdate), 1)")} AS month_start,
           {stamp_sql("o_orderdate + to_minutes(o_orderkey % 1440)")} AS played FROM orders""",
)
def scalar_date(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.date_format(day, "EEEE, MMMM dd, yyyy").alias("long_name"),
        F.date_add(day, 6).alias("week_end"),
        F.last_day(day).alias("month_end"),
        F.dayofmonth(F.last_day(day)).alias("month_length"),
        F.extract(F.lit("month"), day).alias("month"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("age"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("month_start"),
        F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, "o_orderdate").alias("played"),
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
           round(l_extendedprice * (1 - l_discount), 5) AS net, greatest(1, least(10, CAST(l_quantity AS BIGINT))) AS clamped,
           CAST(floor(l_extendedprice / 60) AS BIGINT) AS minutes, l_partkey % 60 AS seconds,
           abs(l_partkey - l_suppkey) AS gap FROM lineitem""",
)
def scalar_math(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 5).alias("net"),
        F.greatest(F.lit(1), F.least(F.lit(10), F.col("l_quantity").cast("bigint"))).alias("clamped"),
        F.floor(F.col("l_extendedprice") / 60).alias("minutes"),
        (F.col("l_partkey") % 60).alias("seconds"),
        F.abs(F.col("l_partkey") - F.col("l_suppkey")).alias("gap"),
    )


@query(
    "scalar_conditional",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END
               AS state, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'none') AS priority,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END IS NULL AS absent, nullif(o_custkey % 5, 0) AS rest
    FROM orders""",
)
def scalar_conditional(spark, sf_dir):
    status = F.col("o_orderstatus")
    some = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other").alias("state"),
        F.coalesce(some, F.lit("none")).alias("priority"),
        some.isNull().alias("absent"),
        F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("rest"),
    )


@query(
    "scalar_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           json_extract_string(props, '$.none') AS absent,
           '{"event":"' || event_type || '","user":' || CAST(user_id AS VARCHAR) || '}' AS body FROM events""",
)
def scalar_json(spark, sf_dir):
    body = F.struct(F.col("event_type").alias("event"), F.col("user_id").alias("user"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.get_json_object("props", "$.none").alias("absent"),
        F.to_json(body).alias("body"),
    )


@query(
    "scalar_collection",
    """SELECT o_orderkey, array_to_string(list_sort([o_orderpriority, o_orderstatus, 'M']), '|') AS sorted,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN CASE o_orderstatus WHEN 'F' THEN CAST(1 AS BIGINT) ELSE 2 END END AS code,
           o_orderstatus IN ('F', 'O') AS known, o_custkey % 7 IN (1, 3, 5) AS listed, CAST(3 AS BIGINT) AS size FROM orders""",
)
def scalar_collection(spark, sf_dir):
    codes = F.create_map(F.lit("F"), F.lit(1), F.lit("O"), F.lit(2))
    entries = F.array("o_orderpriority", "o_orderstatus", F.lit("M"))
    wanted = F.array(*[F.lit(n).cast("bigint") for n in (1, 3, 5)])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.sort_array(entries).alias("sorted"),
        F.try_element_at(codes, F.col("o_orderstatus")).alias("code"),
        F.map_contains_key(codes, F.col("o_orderstatus")).alias("known"),
        F.array_contains(wanted, F.col("o_custkey") % 7).alias("listed"),
        F.size(entries).alias("size"),
    )


@query(
    "scalar_url",
    """SELECT p_partkey, replace(url_encode(p_name || ', ' || p_type), '%20', '+') AS encoded,
           p_name || ', ' || p_type AS decoded FROM part""",
)
def scalar_url(spark, sf_dir):
    encoded = F.url_encode(F.concat("p_name", F.lit(", "), "p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", encoded.alias("encoded"), F.url_decode(encoded).alias("decoded")
    )
