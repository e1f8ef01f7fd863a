from datetime import date, datetime

from pyspark.sql import functions as F

from touchline.operators import ledger, merge
from touchline.schema import CANONICAL
from touchline.sources import sinks


def game(home, away, day, hour, url="https://x.org", headers=None):
    return (datetime(2024, 1, day), home, away, 1, 0, "L", None, url, None, 1.0, headers, datetime(2024, 1, day, hour))


OLD = [game("A", "B", 1, 10), game("C", "D", 2, 16)]
NEW = [game("C", "D", 2, 17, "https://x.org/new", "changed"), game("E", "F", 3, 10)]


def test_upsert_keeps_the_newest(spark):
    old, new = (spark.createDataFrame(rows, CANONICAL) for rows in (OLD, NEW))
    merged = merge.upsert_latest(old, new, merge.GAME_KEY, "timestamp")
    rows = {r.home_team: r for r in merged.collect()}
    assert set(rows) == {"A", "C", "E"}
    assert (rows["C"].url, rows["C"].headers) == ("https://x.org/new", "changed")
    again = merge.upsert_latest(merged, new, merge.GAME_KEY, "timestamp")
    assert sorted(again.collect()) == sorted(merged.collect())


def test_hot_key_is_cut_before_the_shuffle(spark, capsys):
    rows = spark.range(10000).select((F.col("id") % 1).alias("k"), F.col("id").alias("ts"), (-F.col("id")).alias("v"))
    latest = merge.keep_latest(rows, ["k"], "ts")
    latest.explain()
    before_exchange = capsys.readouterr().out.split("Exchange")[1]
    assert "row_number(), 1, Partial" in before_exchange
    assert [tuple(r) for r in latest.collect()] == [(0, 9999, -9999)]


def test_key_parts_cannot_run_together(spark):
    rows = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 2)], "x string, y string, ts int")
    assert merge.keep_latest(rows, ["x", "y"], "ts").count() == 2


def test_keep_first_ignores_absent_key_columns(spark):
    rows = spark.createDataFrame([("d", "A", 2), ("d", "A", 1), ("e", "A", 5)], "date string, home string, n int")
    kept = merge.keep_first(rows, ["date", "field", "home"], ["n"])
    assert sorted(r.n for r in kept.collect()) == [1, 5]


def test_month_table_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "games")
    february = (datetime(2024, 2, 1), *game("X", "Y", 1, 1)[1:])
    sinks.merge_months(spark.createDataFrame([*OLD, february], CANONICAL), path)
    before = sinks.month_versions(spark, path)
    sinks.merge_months(spark.createDataFrame(NEW, CANONICAL), path)
    first = sorted(map(str, sinks.read_months(spark, path).collect()))
    sinks.merge_months(spark.createDataFrame(NEW, CANONICAL), path)
    assert sorted(map(str, sinks.read_months(spark, path).collect())) == first and len(first) == 4
    after = sinks.month_versions(spark, path)
    assert after["2024-02"] == before["2024-02"] and after["2024-01"] != before["2024-01"]


def test_month_merge_that_dies_before_publishing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "games")
    sinks.merge_months(spark.createDataFrame(OLD, CANONICAL), path)
    stored = lambda: sorted(map(str, sinks.read_months(spark, path).collect()))
    old = stored()
    name, months = sinks.write_months(spark.createDataFrame(NEW, CANONICAL), path)
    assert stored() == old
    sinks.publish_months(spark, path, name, months)
    assert len(stored()) == 3 and stored() != old


def updates(spark, *rows):
    shaped = [(date(2024, 1, d), s, n, datetime(2024, 2, 1, h), f) for d, s, n, h, f in rows]
    return spark.createDataFrame(shaped, "date date, status string, games_count bigint, ts timestamp_ntz, force boolean")


def replay(rows):
    """Apply updates one after the other."""
    state = {}
    for d, status, n, hour, force in sorted(rows, key=lambda r: r[3]):
        if force or d not in state:
            state[d] = (status, n, hour)
    return state


def test_first_write_wins_unless_forced(spark):
    rows = [
        (1, "failed", 0, 1, False), (1, "success", 5, 2, False),
        (2, "failed", 0, 1, False), (2, "success", 5, 2, True), (2, "failed", 1, 3, False),
        (3, "success", 2, 4, True), (3, "failed", 9, 5, True), (3, "success", 1, 1, False),
    ]
    got = {r.date.day: (r.status, r.games_count, r.ts.hour) for r in ledger.first_write_wins(updates(spark, *rows)).collect()}
    assert got == replay(rows)


def test_ledger_lookup_and_summary(spark):
    rows = [("scraping", 1, "success"), ("scraping", 2, "success"), ("scraping", 3, "failed"), ("processing", 1, "success")]
    book = spark.createDataFrame([(s, date(2024, 1, d), t) for s, d, t in rows], "stage string, date date, status string")
    assert [r.date.day for r in ledger.unprocessed_dates(book).collect()] == [2]
    inputs = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3, 4)], "date date")
    assert sorted(r.date.day for r in ledger.skip_done(inputs, book, "scraping").collect()) == [3, 4]
    assert ledger.skip_done(inputs, book, "scraping", force=True).count() == 4
    summary = ledger.ledger_summary(book.where("stage = 'scraping'")).first()
    assert summary.total_dates == 2 and [d.day for d in summary.completed_dates] == [1, 2]


def test_ledger_map_round_trip(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", True, 5, "t1"), ("2024-01-02", False, None, "t2")],
        "date string, success boolean, games_count bigint, timestamp string",
    )
    back = ledger.rows_from_map(ledger.map_from_rows(rows), "completed_dates")
    assert sorted(tuple(r) for r in back.collect()) == [("2024-01-01", True, 5, "t1"), ("2024-01-02", False, 0, "t2")]


def test_backfill_states(spark):
    keys = [("p1", "x/backfill_completed.marker"), ("p1", "x/backfill_in_progress.marker"), ("p2", "x/a.jsonl"),
            ("p3", "x/backfill_in_progress.marker"), ("p4", "x/readme")]
    states = ledger.backfill_status(spark.createDataFrame(keys, "p string, key string"), "p").collect()
    assert {r.p: r.status for r in states} == {
        "p1": "COMPLETED", "p2": "COMPLETED", "p3": "IN_PROGRESS", "p4": "NOT_STARTED",
    }
