import json
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import pairs, profile, stats
from touchline.sources import files, sinks
from touchline.sources.scratch import staged
from touchline.streaming import ingest

DDL = "id bigint, name string"


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)


def test_missing_table_is_empty_and_other_errors_raise(spark, tmp_path):
    assert files.scan_table(spark, str(tmp_path / "none"), DDL).count() == 0
    write(tmp_path / "bad" / "part.parquet", "not parquet")
    with pytest.raises(Exception, match=r"(?i)parquet|footer"):
        files.scan_table(spark, str(tmp_path / "bad"), DDL).collect()


def test_json_lines_documents_and_rejects(spark, tmp_path):
    rows = [{"id": i, "name": f"n{i}"} for i in range(5)]
    lines = list(map(json.dumps, rows))
    write(tmp_path / "year=2025" / "a_games.jsonl", "\n".join(["", *lines[:2], "{broken", *lines[2:]]) + "\n")
    write(tmp_path / "year=2025" / "a_meta.json", json.dumps({"id": 99}))
    write(tmp_path / "year=2025" / "b_games.jsonl", json.dumps([{"id": 7, "name": "x"}, 5], indent=2))
    write(tmp_path / "c.json", json.dumps({"id": 8, "name": "y"}, indent=2))
    write(tmp_path / "d.json", "oops\n" + json.dumps({"id": 9}))
    write(tmp_path / "e.json", "\n \n")
    write(tmp_path / "f.json", '[{"id": 1')
    got = sorted(r.id for r in files.json_records(spark, str(tmp_path), DDL).collect())
    assert got == [0, 1, 2, 3, 4, 7, 8, 9]
    rejects = files.json_rejects(spark, str(tmp_path)).collect()
    found = sorted((r.path.rsplit("/", 1)[1], r.text, r.reason) for r in rejects)
    wrong = files.NOT_AN_OBJECT
    assert found == [
        ("a_games.jsonl", "{broken", wrong), ("b_games.jsonl", "5", wrong), ("d.json", "oops", wrong),
        ("e.json", "", files.EMPTY_FILE), ("f.json", '[{"id": 1', wrong),
    ]


def test_listing_rules(spark):
    keys = ["d/day=15/games.jsonl", "d/day=15/meta.json", "d/day=16/games.jsonl", "d/x.txt"]
    listing = spark.createDataFrame([(k,) for k in keys], "key string")
    assert sorted(r.key for r in files.data_files(listing).collect()) == [keys[0], keys[2]]
    paths = ["a/2024-01-05-x/f.json", "a/not-a-date-at-all/2024-02-01.json", "a/2024-13-01/f.json", "a/f.json"]
    listing = spark.createDataFrame([(k,) for k in paths], "key string")
    kept = sorted(r.key for r in files.in_path_dates(listing, "2024-01-05", "2024-01-31").collect())
    assert kept == sorted([paths[0], paths[2], paths[3]])
    pages = ["2024-01-02.html", "2024-01-01.html", "2024-01-03.htm", "x.html", "2024-02-01.html"]
    listing = spark.createDataFrame([(k,) for k in pages], "key string")
    chosen = files.html_day_files(listing, "2024-01-01", "2024-01-31").collect()
    assert [r.file_date for r in chosen] == ["2024-01-01", "2024-01-02"]
    assert files.html_day_files(listing, limit=1).count() == 1


def test_files_changed_strictly_after_the_marker_of_their_prefix(spark):
    at = lambda d: datetime(2025, 2, d)
    rows = [("a", "p", at(1)), ("b", "p", at(2)), ("c", "q", at(10)), ("d", "q", at(21)), ("e", "r", at(26)), ("f", "r", at(28)), ("g", None, at(28))]
    listing = spark.createDataFrame(rows, "key string, prefix string, last_modified timestamp_ntz")
    marker = spark.createDataFrame([("p", at(1)), ("q", at(20))], "prefix string, marker timestamp_ntz")
    changed = lambda m, **k: sorted(r.key for r in files.changed_since(listing, m, "2025-03-01 12:00:00", **k).collect())
    assert changed(marker) == ["b", "d", "f", "g"]
    assert changed(marker.limit(0)) == ["f", "g"]
    assert changed(marker, only_recent=False) == list("abcdefg")


def test_sample_is_exact(spark):
    listing = spark.range(40).select(F.col("id").cast("string").alias("key"))
    assert files.sample_files(listing, 7, 1).distinct().count() == 7
    assert files.sample_files(listing, 100, 1).count() == 40 == files.sample_files(listing, 0, 1).count()


def test_pages_and_documents_from_disk(spark, tmp_path):
    write(tmp_path / "year=2024" / "2024-01-01.html", "<p>\n1\n</p>")
    write(tmp_path / "year=2024" / "2024-01-01.json", "[\n]")
    page = files.html_documents(spark, str(tmp_path)).first()
    assert page.html == "<p>\n1\n</p>" and page.path.endswith("2024-01-01.html")
    assert files.json_documents(spark, str(tmp_path)).first().content == "[\n]"


def test_snapshots_follow_the_pointer(spark, tmp_path):
    path = str(tmp_path / "snap")
    for n in (1, 2, 3):
        sinks.publish_snapshot(spark.range(n), path, f"v{n}")
    assert sinks.read_snapshot(spark, path).count() == 3 and sinks.read_snapshot(spark, path, back=1).count() == 2
    with pytest.raises(ValueError, match="no snapshot"):
        sinks.read_snapshot(spark, str(tmp_path / "other"))


def test_staged_table_keeps_rows(spark):
    assert staged(spark.range(10), "t").agg(F.sum("id")).first()[0] == 45


def test_stream_reads_new_files_once(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("in", "games", "cp"))
    record = {"league_name": "L", "game_date": "2024-01-05", "home_team": "A", "away_team": "B", "score": "1 - 0",
              "timestamp": "2024-01-05T20:00:00"}
    run = lambda: ingest.ingest_available(spark, inbox, table, checkpoint, "2025-03-01 12:00:00", 2025)
    state = lambda: [(r.home_score, r.away_score) for r in sinks.read_months(spark, table).collect()]
    os.makedirs(inbox)
    write(tmp_path / "in" / "1.jsonl", json.dumps(record))
    run()
    assert state() == [(1, 0)]
    write(tmp_path / "in" / "2.jsonl", json.dumps({**record, "score": "4 - 4", "timestamp": "2024-01-04T20:00:00"}))
    run()
    assert state() == [(1, 0)]
    write(tmp_path / "in" / "3.jsonl", json.dumps({**record, "score": "2 - 0", "timestamp": "2030-01-05T20:00:00"}))
    run()
    run()
    assert state() == [(2, 0)]


def test_stream_takes_documents_and_stores_rejects(spark, tmp_path):
    inbox, table, checkpoint, rejects = (str(tmp_path / n) for n in ("in", "games", "cp", "rejects"))
    record = {"league_name": "L", "game_date": "2024-01-05", "home_team": "A", "away_team": "B", "score": "1 - 0"}
    os.makedirs(inbox)
    write(tmp_path / "in" / "1.json", json.dumps([record, {**record, "home_team": "C"}], indent=2))
    write(tmp_path / "in" / "2.jsonl", json.dumps({**record, "home_team": " "}) + "\nnonsense\n")
    for _ in range(2):
        ingest.ingest_available(spark, inbox, table, checkpoint, "2025-03-01 12:00:00", 2025, rejects_path=rejects, files_per_batch=1)
    assert sorted(r.home_team for r in sinks.read_months(spark, table).collect()) == ["A", "C"]
    found = [(r.text[:8], r.errors) for r in ingest.read_rejects(spark, rejects).orderBy("text").collect()]
    assert found == [("nonsense", ["record"]), ('{"league', ["home_team"])]


def test_quantile_ranges_hold_no_more_than_their_share(spark):
    values = spark.range(20000).selectExpr("cast(id as double) v").unionAll(spark.sql("select 1e15D v"))
    got = profile.exact_quantiles(values, ["v"], {"a": 0.5}).first()
    assert got.a == 10000.0
    counts = profile.value_counts(values, ["v"], "double")
    dealt = counts.repartitionByRange(8, "column", "value").groupBy(F.spark_partition_id()).count()
    assert max(r[1] for r in dealt.collect()) < 2.5 * 20001 / 8


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], list(range(101)), [5.0] * 50 + [1e9], [0.1 * i * i for i in range(997)]])
def test_quantiles_match_numpy(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = profile.exact_quantiles(rows, ["v"], {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert np.allclose([got.a, got.b, got.c], np.quantile(values, [0.25, 0.5, 0.9]))


GAMES = [("Rovers A", "B", 3, 1), ("B", "Rovers A", 2, 2), ("Rovers A", "Rovers B", 0, 4), ("C", "D", 1, 0), ("Rovers B", "C", None, 2)]


def test_entity_view_and_properties(spark):
    games = spark.createDataFrame(GAMES, "home_team string, away_team string, home_score bigint, away_score bigint")
    view = pairs.entity_view(games, "%Rovers%")
    got = [(r.entity, r.opponent, r.score, r.opp_score, r.side) for r in view.collect()]
    assert got == [
        ("Rovers A", "B", 3, 1, "home"), ("Rovers A", "B", 2, 2, "away"), ("Rovers A", "Rovers B", 0, 4, "home"),
        ("Rovers B", "C", None, 2, "home"),
    ]
    record = pairs.entity_record(view).first()
    assert (record.games, record.wins, record.losses, record.draws, record.avg_for) == (4, 1, 1, 1, 1.67)
    split = pairs.record_by(view, "opponent", at_least=2).collect()
    assert [(r.opponent, r.games) for r in split] == [("B", 2)]
    summary = stats.outcome_summary(games).first()
    unknown = games.where("home_score IS NULL OR away_score IS NULL").count()
    assert summary.home_wins + summary.away_wins + summary.draws + unknown == summary.games
    assert games.where(pairs.outcome() == "Draw").count() == summary.draws + unknown


def test_shares_sum_to_hundred(spark):
    games = spark.createDataFrame(GAMES, "home_team string, away_team string, home_score bigint, away_score bigint")
    dated = games.withColumn("date", F.lit("2024-01-01").cast("date"))
    columns = ["home_win", "away_win", "draw"]
    shares = stats.row_percent(stats.outcome_pivot(dated, "date"), "year", columns).first()
    assert abs(sum(shares[c] for c in columns) - 100) < 1e-9
    assert stats.goals_summary(games).first().total_goals == 15
    assert stats.unique_sides(games).first()[0] == 5
