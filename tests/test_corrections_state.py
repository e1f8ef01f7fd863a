import datetime as dt
import time

from touchline.schema import CANONICAL
from touchline.sources.scratch import scratch_dir
from touchline.streaming import corrections

D = dt.datetime(2024, 3, 1)


def _game(home_score, away_score, hours, league="L", date=D):
    stamp = None if hours is None else date + dt.timedelta(hours=hours)
    return (date, "A", "B", home_score, away_score, league, None, None, None, None, None, stamp)


def _drop(spark, inbox, rows):
    spark.createDataFrame(rows, CANONICAL).write.mode("append").parquet(inbox)


def _run(spark, inbox, log, checkpoint):
    corrections.run_available(spark.readStream.schema(CANONICAL).parquet(inbox), log, checkpoint)
    return {(r.league, r.home_score, r.away_score, r.timestamp) for r in corrections.current(spark, log).collect()}


def test_newest_version_is_held_across_runs_and_late_corrections(spark):
    inbox, log, checkpoint = (scratch_dir(spark, n) for n in ("inbox", "changes", "checkpoint"))
    _drop(spark, inbox, [_game(1, 0, 5), _game(2, 0, 3), _game(None, 1, None, league=None), _game(7, 7, 2, league="M")])
    first = _run(spark, inbox, log, checkpoint)
    assert first == {("L", 1, 0, D + dt.timedelta(hours=5)), (None, None, 1, None), ("M", 7, 7, D + dt.timedelta(hours=2))}
    # A later run, a new stream on the same checkpoint: older versions change nothing, a late newer one replaces.
    _drop(spark, inbox, [_game(9, 9, 4), _game(3, 3, 50), _game(0, 0, 1, league=None), _game(6, 7, 2, league="M"), _game(5, 7, 2, league="M")])
    second = _run(spark, inbox, log, checkpoint)
    assert second == {("L", 3, 3, D + dt.timedelta(hours=50)), (None, 0, 0, D + dt.timedelta(hours=1)), ("M", 5, 7, D + dt.timedelta(hours=2))}
    changes = spark.read.schema(corrections.LOG).parquet(log)
    assert changes.count() == 6
    assert changes.where("change = 'insert'").count() == 3
    # Nothing new: no change is logged.
    assert _run(spark, inbox, log, checkpoint) == second
    assert spark.read.schema(corrections.LOG).parquet(log).count() == 6


def test_empty_inbox(spark):
    inbox, log, checkpoint = (scratch_dir(spark, n) for n in ("inbox", "changes", "checkpoint"))
    spark.createDataFrame([], CANONICAL).write.parquet(inbox)
    assert _run(spark, inbox, log, checkpoint) == set()


def test_a_game_costs_no_call_of_its_own(spark):
    """5,000 games of two months: at some 40 ms of state calls a game this took minutes."""
    inbox, log, checkpoint = (scratch_dir(spark, n) for n in ("inbox", "changes", "checkpoint"))
    games = [_game(i % 5, 0, i % 7, league=f"L{i}", date=D + dt.timedelta(days=i % 50)) for i in range(5000)]
    _drop(spark, inbox, games + [_game(9, 9, 1, league=None, date=D) for _ in range(2)])
    begun = time.monotonic()
    assert len(_run(spark, inbox, log, checkpoint)) == 5001
    assert spark.read.schema(corrections.LOG).parquet(log).count() == 5001
    assert time.monotonic() - begun < 30
