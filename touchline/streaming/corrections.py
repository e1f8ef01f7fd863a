"""Late corrections held in keyed state: the newest version of every game and a log of its changes.

A stream of game versions is grouped by month and part of the month's games; a
stateful function (``applyInPandasWithState``, state in RocksDB under the
checkpoint) holds the newest version seen of every game of its group and emits
a change row only when a batch brings a newer one. State travels with the rows
and serves all games of a group in one call, so neither a game nor a group costs
a round trip to a state server. There is no age limit: state lives as long as the game, so a correction
months late still replaces what is held, and a batch rewrites the state of the
groups it changes only. The change log is an append-only table; the current
version of a game is its latest change.

Newest means: latest ``timestamp`` (null last), then smallest home score,
then smallest away score (nulls last), the order of the month rewrite, so both
ways give the same table. A replayed batch re-emits nothing, because the held
version is no older than what it brings.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEY = ["date", "home_team", "away_team", "league"]
LOG = (
    "date timestamp_ntz, home_team string, away_team string, league string, home_score long, away_score long, "
    "timestamp timestamp_ntz, previous timestamp_ntz, change string"
)
# Games of a group: the key and the version, one array a field, all of one length.
_HELD = (
    "date array<long>, home_team array<string>, away_team array<string>, league array<string>, "
    "micros array<long>, home array<long>, away array<long>"
)
_PARTS = 16  # groups a month, so that a call holds a share of its games
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NO_TIME = np.iinfo(np.int64).min  # how numpy writes a null stamp


def _numbers(values: pd.Series) -> list:
    return [None if v is None or v != v else int(v) for v in values.tolist()]


def _micros(values: pd.Series) -> list:
    whole = pd.to_datetime(values).to_numpy("datetime64[us]").astype("int64").tolist()
    return [None if v == _NO_TIME else v for v in whole]


def _texts(values: pd.Series) -> list:
    return [v if isinstance(v, str) else None for v in values.tolist()]


def _rank(version):
    """Smaller is newer."""
    micros, home, away = version
    return (micros is None, -(micros or 0), home is None, home or 0, away is None, away or 0)


def _stamps(micros: list) -> pd.Series:
    return pd.Series(np.array([_NO_TIME if m is None else m for m in micros], "int64").view("datetime64[us]"))


def newest_versions(_group, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps the newest version of every game of a group; yields the change rows of a batch."""
    best = {}
    for batch in rows:
        games = zip(_micros(batch["date"]), *(_texts(batch[c]) for c in KEY[1:]))
        versions = zip(_micros(batch["timestamp"]), _numbers(batch["home_score"]), _numbers(batch["away_score"]))
        for game, version in zip(games, versions):
            if game not in best or _rank(version) < _rank(best[game]):
                best[game] = version
    held = {row[:4]: row[4:] for row in zip(*state.get)} if state.exists else {}
    newer = {g: v for g, v in best.items() if g not in held or _rank(v) < _rank(held[g])}
    if not newer:
        return
    before = [held.get(game) for game in newer]
    held.update(newer)
    state.update(tuple(list(c) for c in zip(*(game + version for game, version in held.items()))))
    date, home_team, away_team, league, micros, home, away = zip(*(g + v for g, v in newer.items()))
    yield pd.DataFrame(
        {
            "date": _stamps(date),
            "home_team": home_team,
            "away_team": away_team,
            "league": league,
            "home_score": pd.Series(home, dtype="Int64"),
            "away_score": pd.Series(away, dtype="Int64"),
            "timestamp": _stamps(micros),
            "previous": _stamps([old[0] if old else None for old in before]),
            "change": ["update" if old else "insert" for old in before],
        }
    )


def changes(stream: DataFrame) -> DataFrame:
    """The change log of a stream of game versions (columns of :data:`KEY`, scores and ``timestamp``)."""
    month = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("")).alias("month")
    part = F.pmod(F.xxhash64(*KEY), F.lit(_PARTS)).alias("part")
    versions = stream.select(month, part, *KEY, "home_score", "away_score", "timestamp")
    return versions.groupBy("month", "part").applyInPandasWithState(newest_versions, LOG, _HELD, "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, log_path: str, checkpoint: str) -> None:
    """Append the changes of everything that is there to ``log_path`` and stop.

    State and offsets live under ``checkpoint``; a run that dies is taken up
    from the last finished batch by the next one.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    query = (
        changes(stream).writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current(spark: SparkSession, log_path: str) -> DataFrame:
    """The held version of every game: its latest change in the log (later changes are always newer)."""
    log = spark.read.schema(LOG).parquet(log_path)
    order = F.struct(F.col("timestamp").isNotNull(), "timestamp", F.col("home_score").isNotNull(), -F.col("home_score"),
                     F.col("away_score").isNotNull(), -F.col("away_score"))
    newest = log.groupBy(*KEY).agg(F.max_by(F.struct("home_score", "away_score", "timestamp"), order).alias("v"))
    return newest.select(*KEY, "v.home_score", "v.away_score", "v.timestamp")
