import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.functions import text
from touchline.operators import ingest

RUN = "2025-03-01 12:00:00"

GAME = {"home_team": "Rovers", "away_team": "Harbour", "home_score": 3, "away_score": 3, "league": "Coast", "time": "6:15 PM"}
OUTER = {"url": "http://fixtures.example/9", "status": 0.5}
FLAT = {
    **OUTER, "league_name": GAME["league"], "game_date": "2024-09-30", "home_team": GAME["home_team"],
    "away_team": GAME["away_team"], "score": "3 - 3", "game_time": GAME["time"], "game_type": "cup",
}
NESTED = {**OUTER, "date": "2024-09-30", "type": "cup", "games": GAME}


def run(spark, *records):
    lines = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    cleaned = ingest.ingest(spark.createDataFrame(lines, "id int, content string"), RUN, 2025)
    good = [r.asDict() for r in ingest.valid_rows(cleaned).collect()]
    bad = [(r.id, r.shape, r.errors) for r in ingest.quarantine_rows(cleaned).collect()]
    return good, sorted(bad)


def test_both_shapes_give_the_same_row(spark):
    good, bad = run(spark, FLAT, NESTED)
    assert not bad and good[0] == good[1]
    row = good[0]
    assert (row["home_score"], row["away_score"], row["league"]) == (3, 3, "Coast")
    assert row["date"] == datetime(2024, 9, 30) and row["time"] == "6:15 PM"
    assert row["timestamp"] == datetime(2025, 3, 1, 12)


def test_missing_fields_and_odd_scores_are_nulls(spark):
    short = {k: FLAT[k] for k in ("league_name", "game_date", "home_team", "away_team")}
    good, bad = run(spark, {**short, "score": "postponed"}, short)
    assert not bad
    assert [[r[c] for c in ("home_score", "away_score", "url", "status", "type")] for r in good] == [[None] * 5] * 2


def test_list_of_games_skips_null_elements(spark):
    other = {**NESTED["games"], "home_team": "C"}
    good, bad = run(spark, {**NESTED, "games": [NESTED["games"], None, other]}, {**NESTED, "games": []})
    assert not bad and sorted(r["home_team"] for r in good) == ["C", "Rovers"]


def test_every_input_leaves_a_trace(spark):
    """Keys count even if null; a bad element costs no other; no text and no games are reported."""
    inputs = [{**FLAT, "league_name": None}, {**NESTED, "games": [GAME, 5, "x"]}, "", {"date": "2024-09-30"}, {**NESTED, "games": [None]}]
    good, bad = run(spark, *inputs)
    assert [r["home_team"] for r in good] == ["Rovers"]
    assert bad == [
        (0, "flat", ["league"]), (1, "unparsable", ["record"]), (1, "unparsable", ["record"]),
        (2, "unparsable", ["record"]), (3, "unparsable", ["record"]),
    ]


def test_each_rule_rejects(spark):
    game = NESTED["games"]
    records = [
        {**FLAT, "home_team": "  "},
        {**FLAT, "url": "ftp://x"},
        {**FLAT, "status": 1.5},
        {**FLAT, "game_date": "2025-02-30"},
        {**NESTED, "games": {**game, "home_score": -1}},
        {**NESTED, "games": {**game, "away_score": "x"}},
        {**NESTED, "games": 3},
        {**FLAT, "timestamp": "never"},
        '{"date": "2025',
        "[1, 2]",
    ]
    good, bad = run(spark, *records)
    assert not good
    assert [e for _, _, e in bad] == [
        ["home_team"], ["url"], ["status"], ["date"], ["score"], ["score"], ["record"], ["timestamp"], ["record"],
        ["record"],
    ]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2024-01-05", datetime(2024, 1, 5)),
        ("2024-01-05T10:00:00-05:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05T10:00:00Z", datetime(2024, 1, 5, 10)),
        ("2024-01-05 10:00:00.25", datetime(2024, 1, 5, 10, 0, 0, 250000)),
        ("Sat-Jun 1", datetime(2025, 6, 1)),
        ("Sat-Foo 9", datetime(2025, 1, 9)),
        ("Mon-Feb 30", None),
        ("2024-1-5", None),
        ("junk", None),
    ],
)
def test_game_dates(spark, raw, expected):
    row = spark.createDataFrame([(raw,)], "d string").select(text.game_date(F.col("d"), 2025).alias("d")).first()
    assert row.d == expected


@pytest.mark.parametrize(
    ("score", "home", "away"),
    [
        ("4 - 1", 4, 1),
        ("12 - 0", 12, 0),
        ("-1 - 2", -1, 2),
        (" 4  -  1 ", 4, 1),
        ("4 - x", 4, None),
        ("x - 4", None, None),
        ("4-1", None, None),
        ("4 - 1 - 2", None, None),
        ("4 -", None, None),
        (" - 1", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_scores(spark, score, home, away):
    left, right = text.score_parts(F.col("s"))
    row = spark.createDataFrame([(score,)], "s string").select(left.alias("h"), right.alias("a")).first()
    assert (row.h, row.a) == (home, away)


def test_day_files_of_every_shape(spark):
    game = {"home_team": "A", "away_team": "B", "home_score": 1, "away_score": 0, "time": "7 PM"}
    docs = [
        ("/d/2024-03-01.json", json.dumps([{**game, "league_name": "L1"}], indent=2)),
        ("/d/2024-03-02.json", json.dumps({"date": "2024-03-09", "games_found": True, "games": [{**game, "league": "L2"}]})),
        ("/d/2024-03-03.json", json.dumps({"games_found": False, "games": [game]})),
        ("/d/2024-03-04.json", json.dumps(game)),
        ("/d/2024-03-05.json", "{broken"),
        ("/d/2024-03-06_meta.json", json.dumps([game])),
    ]
    parsed = ingest.day_documents(spark.createDataFrame(docs, "path string, content string"))
    flat = ingest.flatten_three_shapes(parsed)
    assert sorted(r.date for r in flat.collect()) == [
        "2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04", "2024-03-06_meta",
    ]
    legacy = {(str(r.date)[:10], r.league) for r in ingest.legacy_to_canonical(parsed, RUN).collect()}
    assert legacy == {("2024-03-01", "L1"), ("2024-03-09", "L2"), ("None", "")}
    gated = ingest.flatten_gated(parsed, RUN).collect()
    assert [(r.source_date, r.year, r.month, r.day) for r in gated] == [("2024-03-02", 2024, 3, 2)]
    stats = ingest.conversion_stats(parsed).first()
    assert (stats.total_files, stats.converted_files, stats.total_games, stats.errors) == (6, 3, 3, 1)


@pytest.mark.parametrize("name", ["valid_rows", "quarantine_rows"])
def test_generated_code_stays_small_and_rows_are_dealt_out(spark, name):
    """The JVM never compiles methods above 8,000 bytes; one partition of the feed would leave cores idle."""
    from touchline.plans import catalog

    rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.01")
    assert rows.groupBy(F.spark_partition_id()).count().count() > 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows.select("*")
        stages = plan._jdf.queryExecution().debug().codegenToSeq()
        sizes = [int(stages.apply(i)._3().toString().split("(")[1].split(",")[0]) for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000


def test_keys_of_flat_records_may_be_escaped(spark):
    """A record is read for its keys wherever its text might hold them, also with escapes."""
    escaped = json.dumps(FLAT).replace("league_name", "league\\u005fname")
    inside = json.dumps({**NESTED, "type": "league_name game_date"})
    good, bad = run(spark, escaped, inside)
    assert not bad and [(r["home_team"], r["type"]) for r in good] == [("Rovers", "cup"), ("Rovers", "league_name game_date")]
