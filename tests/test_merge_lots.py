"""Months are merged lot by lot, and what a run needed for its merge goes with it."""

import os
from datetime import datetime

from test_scratch import shuffle_bytes

from touchline.schema import CANONICAL
from touchline.sources import sinks
from touchline.sources.scratch import scratch_dir
from touchline.streaming import ingest

LINE = '{{"league_name": "L", "game_date": "2025-0{}-01", "home_team": "A", "away_team": "T{}", "score": "1 - 0"}}'


def test_lots_hold_whole_months_and_stay_few():
    assert sinks.month_lots({}) == []
    assert sinks.month_lots({"2025-02": 1, "2025-01": 1, "none": 1}) == [["2025-01", "2025-02", "none"]]
    most = sinks.ROWS_PER_LOT
    assert sinks.month_lots({"a": most, "b": most // 2, "c": most // 2, "d": 9 * most}) == [["a"], ["b", "c"], ["d"]]
    many = sinks.month_lots({f"{i:05}": most for i in range(960)})
    assert sum(many, []) == [f"{i:05}" for i in range(960)] and {len(lot) for lot in many} == {60}


def test_lots_give_the_same_table(spark, monkeypatch):
    def games(hour, score):
        days = [*(datetime(2025, month, 5) for month in range(1, 8)), None]
        at = datetime(2025, 9, 1, hour)
        rows = [(day, "A", f"T{i}", score, 0, "L", None, None, None, None, None, at) for day in days for i in range(3)]
        return spark.createDataFrame(rows, CANONICAL)

    tables = []
    for most in (sinks.ROWS_PER_LOT, 7):
        monkeypatch.setattr(sinks, "ROWS_PER_LOT", most)
        path = scratch_dir(spark, "lots")
        for incoming in (games(2, 2), games(1, 1).where("date > '2025-03-01'"), games(3, 3).where("date < '2025-03-01' OR date IS NULL")):
            sinks.merge_months(incoming, path)
        assert len([d for d in os.listdir(f"{path}/data") if d.startswith("copy=")]) == 3
        tables.append(sorted(map(str, sinks.read_months(spark, path).collect())))
    assert tables[0] == tables[1] and len(tables[0]) == 24


def test_a_run_keeps_neither_merged_rows_nor_shuffle_files(spark, tmp_path):
    table, checkpoint, rejects = (scratch_dir(spark, n) for n in ("table", "checkpoint", "rejects"))
    (tmp_path / "lines.json").write_text("\n".join(LINE.format(1 + i % 9, i) for i in range(20_000)))
    was = shuffle_bytes(spark)
    for _ in range(2):
        ingest.ingest_available(spark, str(tmp_path), table, checkpoint, "2025-03-01 12:00:00", 2025, rejects_path=rejects)
    assert sinks.read_months(spark, table).count() == 20_000
    assert not [f for f in os.listdir(f"{checkpoint}/_checked") if f.startswith("batch=")]
    assert shuffle_bytes(spark) - was < 100_000
