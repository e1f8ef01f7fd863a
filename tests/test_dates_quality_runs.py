from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from touchline.operators import dates, quality, runs


def ranges(spark, *rows):
    return spark.createDataFrame(
        [(i, date.fromisoformat(a), date.fromisoformat(b)) for i, (a, b) in enumerate(rows)],
        "id int, start_date date, end_date date",
    )


def test_small_range_is_not_split(spark):
    rows = dates.range_chunks(ranges(spark, ("2023-01-01", "2023-01-10"))).collect()
    assert len(rows) == 1 and not rows[0].split_required


def test_long_range_splits_into_four(spark):
    rows = dates.range_chunks(ranges(spark, ("2023-01-01", "2023-06-30")), 60).orderBy("batch_start").collect()
    assert len(rows) == 4 and all(r.split_required for r in rows)
    assert rows[0].batch_start == date(2023, 1, 1) and rows[-1].batch_end == date(2023, 6, 30)
    for a, b in zip(rows, rows[1:], strict=False):
        assert b.batch_start == a.batch_end + timedelta(days=1)


@pytest.mark.parametrize("size", [1, 3, 7, 10])
def test_batches_tile_the_range(spark, size):
    r = ranges(spark, ("2024-02-20", "2024-03-11"), ("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-01"))
    days = dates.date_spine(dates.date_batches(r, size), "batch_start", "batch_end")
    assert sorted((x.id, x.date) for x in days.select("id", "date").collect()) == sorted(
        (x.id, x.date) for x in dates.date_spine(r).select("id", "date").collect()
    )
    assert dates.date_batches(r, size).agg(F.sum("days")).first()[0] == 22


def test_coverage_and_missing(spark):
    r = ranges(spark, ("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-01-02"))
    data = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 2),)], "date date")
    rows = {x.id: x for x in dates.coverage_summary(r, data, ["id"]).collect()}
    assert (rows[0].total_days, rows[0].processed_days, rows[0].success) == (3, 1, False)
    assert [d.day for d in rows[0].missing_days] == [1, 3]
    assert rows[1].success and rows[1].missing_days == []
    assert dates.missing_dates(r, data).count() == 2


def test_recorded_results_come_before_the_data(spark):
    r = ranges(spark, ("2024-01-01", "2024-01-02"), ("2024-01-01", "2024-01-01"))
    results = spark.createDataFrame(
        [(0, {date(2024, 1, 1): True}), (0, {date(2024, 1, 2): False})], "id int, results map<date, boolean>"
    )
    data = spark.createDataFrame([(date(2024, 1, 1),)], "date date")
    rows = {x.id: x for x in dates.verify_results(r, results, data, ["id"]).collect()}
    assert [d.day for d in rows[0].missing_days] == [2] and not rows[0].success
    assert rows[1].success and rows[1].total_days == 1


def test_month_days_keep_existing_days_only(spark):
    requests = spark.createDataFrame(
        [(1, date(2023, 2, 1), [30, 28, 0, 3]), (2, date(2024, 2, 1), None)],
        "id int, month_start date, target_days array<int>",
    )
    rows = dates.month_days(requests).collect()
    assert sorted(r.date.day for r in rows if r.id == 1) == [3, 28]
    assert sum(r.id == 2 for r in rows) == 29


def test_game_errors_in_order(spark):
    schema = "date string, league_name string, home_team string, away_team string, field string"
    games = spark.createDataFrame(
        [("2024-1-5", "L", "A", "B", "Field 1"), (None, "", "A", "A", "Court"), ("2024-02-30", "L", None, None, None)], schema
    )
    errors = [r.errors for r in quality.with_errors(games).collect()]
    assert errors[0] == []
    assert errors[1] == [
        "Missing required field: date", "Missing required field: league_name", "Invalid date format",
        "Home team and away team are the same", "Invalid field format",
    ]
    assert errors[2][-2:] == ["Invalid date format", "Home team and away team are the same"]


def test_run_status(spark):
    schema = "run_id int, status string"
    empty = runs.status_rollup(spark.createDataFrame([], schema)).first()
    assert empty.success and empty.runs == 0
    good = spark.createDataFrame([(1, "SUCCEEDED"), (2, "SUCCEEDED")], schema)
    assert runs.status_rollup(good).first().success
    assert [tuple(r) for r in runs.status_counts(good).collect()] == [("SUCCEEDED", 2)]
    for other in ("RUNNING", "FAILED", "ERROR", None):
        mixed = good.union(spark.createDataFrame([(3, other)], schema))
        assert not runs.status_rollup(mixed).first().success


def test_state_durations_use_the_last_entry(spark):
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    log = spark.createDataFrame(
        [("r", "A", 1, at(0), "in"), ("r", "A", 2, at(10), "bad"), ("r", "A", 3, at(20), "in"), ("r", "A", 4, at(145), "out"),
         ("r", "B", 5, at(0), "in"), ("r", "B", 6, at(61), "bad"), ("r", "C", 7, at(1), "in"), ("r", "D", 8, at(1), "out")],
        "run_id string, state string, id bigint, timestamp timestamp_ntz, type string",
    )
    rows = {r.state: r for r in runs.state_durations(log, "in", "out", "bad").collect()}
    assert {s: (r.status, r.duration) for s, r in rows.items()} == {
        "A": ("COMPLETED", "2m 5s"), "B": ("FAILED", "1m 1s"), "C": ("UNKNOWN", "N/A"),
    }
