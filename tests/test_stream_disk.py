"""What runs of the ingest leave on disk: no second copy of texts that were only read."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from touchline.plans import stream_queries
from touchline.sources import files, scratch
from touchline.sources.scratch import scratch_dir
from touchline.streaming import ingest

GOOD = '{"league_name": "L", "game_date": "2025-01-01", "home_team": "A", "away_team": "B", "score": "1 - 0"}'
BAD = GOOD.replace("2025-01-01", "someday")


def test_lines_are_not_shuffled(spark, tmp_path):
    lines = [json.dumps({"id": i, "text": os.urandom(200).hex()}) for i in range(1000)]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    (tmp_path / "array.json").write_text('[{"id": -1},\n{"id": -2}]')
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100_000)  # less than the texts
    try:
        texts = files.json_texts(spark, str(tmp_path))
        assert "SortMergeJoin" not in texts._jdf.queryExecution().executedPlan().toString()
        assert sorted(json.loads(r.text)["id"] for r in texts.collect()) == [-2, -1, *range(1000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listed_files_are_opened_for_their_own_kind_only(spark, tmp_path):
    for name, text in {"lines": '\n{"id": 1}\nno\n', "a b": '[{"id": 2},\r\n7]', "one": '{\n"id": 3\n}', "blank": "\n \n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "packed.json.gz").write_bytes(gzip.compress(b'{"id": 4}\n{"id": 5}'))
    listed = files.json_texts(spark, [str(f) for f in tmp_path.iterdir()], keep=lambda _path: F.lit(True))
    folder = files.json_texts(spark, str(tmp_path), keep=lambda _path: F.lit(True))
    assert sorted(map(str, listed.collect())) == sorted(map(str, folder.collect())) and listed.count() == 8
    assert "LeftSemi" not in listed._jdf.queryExecution().executedPlan().toString()


def test_kinds_of_files_are_found_without_sorting_texts(spark, tmp_path, monkeypatch):
    (tmp_path / "splits.json").write_text("\n" * 300 + "\n".join(json.dumps({"id": i}) for i in range(100)))
    (tmp_path / "broken.json").write_text("\nno\n" + "\n".join(json.dumps({"id": i}) for i in range(100, 200)))
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return scratch.staged(df, label)

    monkeypatch.setattr(files, "staged", seen)
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, "64")
    try:
        texts = files.json_texts(spark, str(tmp_path))
        assert sorted(json.loads(r.text)["id"] for r in texts.where("reason IS NULL").collect()) == list(range(200))
        assert [r.text for r in texts.where("reason IS NOT NULL").collect()] == ["no"]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(plans) == 1 and "SortAggregate" not in plans[0]


def test_compressed_files_are_read_and_only_texts_of_failed_rows_wait(spark, tmp_path, monkeypatch):
    for name, text in {"lines": f"{GOOD}\n{BAD}\n", "array": f"[\n{GOOD},\n{BAD}\n]"}.items():
        (tmp_path / f"{name}.json.gz").write_bytes(gzip.compress(text.encode()))
    table, checkpoint, rejects = (scratch_dir(spark, n) for n in ("table", "checkpoint", "rejects"))

    def dies(*_args):
        raise OSError("gone")

    monkeypatch.setattr(ingest, "merge_months", dies)
    with pytest.raises(OSError):
        ingest.ingest_available(spark, str(tmp_path), table, checkpoint, "2025-03-01 12:00:00", 2025, rejects_path=rejects)
    waiting = spark.read.parquet(f"{checkpoint}/_checked").collect()
    assert sorted((r.errors, r.text is None) for r in waiting) == [("", True), ("", True), ("date", False), ("date", False)]
    assert {json.loads(r.text)["game_date"] for r in ingest.read_rejects(spark, rejects).collect()} == {"someday"}


def test_runs_leave_compressed_files_and_no_records(spark, tmp_path, monkeypatch):
    def below(_spark, label):
        return f"{tmp_path}/{label}"

    monkeypatch.setattr(scratch, "scratch_dir", below)
    monkeypatch.setattr(stream_queries, "scratch_dir", below)
    stream_queries._ingested(spark, "/root/testdata/sf0.001")
    assert {f.name for f in tmp_path.iterdir()} == {"inbox", "games", "rejects", "checkpoint"}
    assert {f.suffix for f in (tmp_path / "inbox").rglob("part-*")} == {".gz"}
