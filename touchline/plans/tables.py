"""Relations the registered queries run on, derived from the given tables.

``contests`` is a two-sided relation over the order tables. Only the joins
that the asked attributes need are made. No side is hinted as broadcast: small
dimension sides go broadcast by their measured size, large ones are merged,
and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "%NATION_1%"
RUN_TS = "2025-03-01 12:00:00"
YEAR = 2025


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contests(source: SparkSession | DataFrame, sf_dir: str, *attributes: str) -> DataFrame:
    """Games: ``game_date``, scores and keys, plus the asked ``attributes``.

    Attributes: ``home_team``, ``away_team``, ``league``, ``venue``. Pass an
    already filtered ``lineitem`` as the source to restrict the games.
    """
    lines = source if isinstance(source, DataFrame) else table(source, sf_dir, "lineitem")
    load = lambda name: table(lines.sparkSession, sf_dir, name)
    played = F.col("l_linenumber") != 7
    games = lines.select(
        F.to_date("l_shipdate").alias("game_date"),
        F.when(played, F.floor("l_quantity") % 7).alias("home_score"),
        F.when(played, F.floor("l_extendedprice") % 7).alias("away_score"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
    )
    nation = load("nation")
    if "home_team" in attributes:
        supplier = load("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        supplier = supplier.select("s_suppkey", F.col("n_name").alias("home_team"))
        games = games.join(supplier, games["l_suppkey"] == supplier["s_suppkey"]).drop("s_suppkey")
    if "venue" in attributes:
        part = load("part").select("p_partkey", F.col("p_brand").alias("venue"))
        games = games.join(part, games["l_partkey"] == part["p_partkey"]).drop("p_partkey")
    if "away_team" in attributes or "league" in attributes:
        orders = load("orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("league"))
        if "away_team" in attributes:
            customer = load("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            customer = customer.select("c_custkey", F.col("n_name").alias("away_team"))
            orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        games = games.join(orders, games["l_orderkey"] == orders["o_orderkey"])
    ordered = [a for a in ("home_team", "away_team", "league", "venue") if a in attributes]
    return games.select("game_date", *ordered, "home_score", "away_score", "l_orderkey", "l_linenumber")


def contests_sql(*attributes: str) -> str:
    """The same relation as the common table expression ``contests``."""
    joins, columns = "", ""
    if "home_team" in attributes:
        joins += " JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey"
        columns += ", sn.n_name AS home_team"
    if "venue" in attributes:
        joins += " JOIN part ON l_partkey = p_partkey"
        columns += ", p_brand AS venue"
    if "away_team" in attributes or "league" in attributes:
        joins += " JOIN orders ON l_orderkey = o_orderkey"
    if "league" in attributes:
        columns += ", o_orderpriority AS league"
    if "away_team" in attributes:
        joins += " JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey"
        columns += ", cn.n_name AS away_team"
    return f"""contests AS (
        SELECT CAST(l_shipdate AS DATE) AS game_date{columns},
               CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_quantity) AS BIGINT) % 7 END AS home_score,
               CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_extendedprice) AS BIGINT) % 7 END AS away_score,
               l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
        FROM lineitem{joins})"""


def entity_sql(*attributes: str) -> str:
    """``contests`` and the entity view on top of it, as common table expressions."""
    wanted = {"home_team", "away_team", *attributes}
    return f"""{contests_sql(*sorted(wanted))},
    view AS (
        SELECT *, CASE WHEN home_team LIKE '{ENTITY}' THEN home_team ELSE away_team END AS entity,
               CASE WHEN home_team LIKE '{ENTITY}' THEN away_team ELSE home_team END AS opponent,
               CASE WHEN home_team LIKE '{ENTITY}' THEN home_score ELSE away_score END AS score,
               CASE WHEN home_team LIKE '{ENTITY}' THEN away_score ELSE home_score END AS opp_score,
               CASE WHEN home_team LIKE '{ENTITY}' THEN 'home' ELSE 'away' END AS side
        FROM contests WHERE home_team LIKE '{ENTITY}' OR away_team LIKE '{ENTITY}')"""
