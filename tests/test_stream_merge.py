"""Batches of one run of the ingest are merged at once, and a run that dies before its merge loses nothing."""

import os

import pytest

from touchline.sources import sinks
from touchline.sources.scratch import scratch_dir
from touchline.streaming import ingest

LINE = '{{"league_name": "L", "game_date": "2025-0{}-01", "home_team": "A", "away_team": "{}", "score": "1 - 0", "timestamp": "2025-01-01 0{}:00:00"}}'


def _paths(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    table, checkpoint, rejects = (scratch_dir(spark, n) for n in ("table", "checkpoint", "rejects"))

    def run():
        ingest.ingest_available(spark, str(inbox), table, checkpoint, "2025-03-01 12:00:00", 2025, rejects_path=rejects, files_per_batch=1)

    def teams():
        return sorted(r.away_team for r in sinks.read_months(spark, table).collect())

    return inbox, table, rejects, run, teams


def test_months_are_rewritten_once_a_run(spark, tmp_path):
    inbox, table, rejects, run, teams = _paths(spark, tmp_path)
    for i in range(4):
        (inbox / f"{i}.json").write_text(LINE.format(1, f"T{i}", i) + "\n" + LINE.format(1, "same", i) + "\nnothing\n")
    run()
    assert teams() == ["T0", "T1", "T2", "T3", "same"]
    assert sinks.read_months(spark, table).where("away_team = 'same'").first().timestamp.hour == 3
    assert len([d for d in os.listdir(f"{table}/data") if d.startswith("copy=")]) == 1
    assert ingest.read_rejects(spark, rejects).count() == 4
    (inbox / "late.json").write_text(LINE.format(2, "late", 5))
    run()
    run()
    assert teams() == ["T0", "T1", "T2", "T3", "late", "same"]
    assert len([d for d in os.listdir(f"{table}/data") if d.startswith("copy=")]) == 2


def test_a_run_that_dies_before_its_merge_is_made_up_for(spark, tmp_path, monkeypatch):
    inbox, _, rejects, run, teams = _paths(spark, tmp_path)
    for i in range(2):
        (inbox / f"{i}.json").write_text(LINE.format(1, f"T{i}", i) + "\n{}\n")

    def dies(*_args):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "merge_months", dies)
        with pytest.raises(OSError):
            run()
    assert teams() == []
    run()
    assert teams() == ["T0", "T1"]
    assert ingest.read_rejects(spark, rejects).count() == 2
