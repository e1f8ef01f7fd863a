from datetime import date, timedelta

from touchline.operators import dates, stats

D = lambda n: date(2024, 1, 1) + timedelta(days=n)


def expand(rows):
    return sorted((k, s + timedelta(days=i)) for k, s, e, n in rows for i in range(n) if s + timedelta(days=i) <= e)


def test_gap_ranges_expand_to_missing_dates(spark):
    ranges = spark.createDataFrame(
        [(1, D(0), D(30)), (2, D(5), D(5)), (3, D(40), D(80)), (4, D(10), D(3)), (5, None, D(3)), (6, D(-20), D(2)), (1, D(0), D(30))],
        "o_orderkey long, start_date date, end_date date",
    )
    data = spark.createDataFrame([(D(d),) for d in (1, 2, 3, 10, 11, 25, 5, 5, 90, -100)] + [(None,)], "date date")
    got = [tuple(r) for r in dates.gap_ranges(ranges, data, "o_orderkey").collect()]
    assert all(n == (e - s).days + 1 and s <= e for _, s, e, n in got)
    want = sorted((r.o_orderkey, r.date) for r in dates.missing_dates(ranges, data).collect())
    assert expand(got) == want
    # Maximal runs: no two gaps of one range touch.
    runs = sorted((k, s, e) for k, s, e, _ in got)
    assert all(not (a[0] == b[0] and a[2] + timedelta(days=1) == b[1]) for a, b in zip(runs, runs[1:]))


def test_gap_ranges_without_data_or_ranges(spark):
    ranges = spark.createDataFrame([(1, D(0), D(9))], "o_orderkey long, start_date date, end_date date")
    empty = spark.createDataFrame([], "date date")
    assert [tuple(r) for r in dates.gap_ranges(ranges, empty, "o_orderkey").collect()] == [(1, D(0), D(9), 10)]
    assert dates.gap_ranges(ranges.limit(0), empty, "o_orderkey").count() == 0


def test_calendar_rollup_tells_null_keys_from_subtotals(spark):
    games = spark.createDataFrame([(D(0), "A"), (D(0), None), (D(40), "A"), (D(400), "B")], "game_date date, league string")
    rows = {(r.league, r.year, r.month, r.day, r.level): r.games for r in stats.calendar_rollup(games, "game_date", "league").collect()}
    assert rows[(None, None, None, None, 15)] == 4  # grand total
    assert rows[(None, None, None, None, 7)] == 1  # the null league
    assert rows[("A", None, None, None, 7)] == 2 and rows[(None, 2024, None, None, 11)] == 3
    assert rows[(None, 2024, 1, 1, 8)] == 2 and rows[(None, 2024, 1, 1, 0)] == 1
