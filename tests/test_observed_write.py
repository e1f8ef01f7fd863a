from datetime import datetime

from pyspark.sql import functions as F

from touchline.sources import sinks
from touchline.sources.scratch import scratch_dir

SCHEMA = "id long, kind_of string, value double, ts timestamp_ntz"


def test_counts_come_from_the_write_and_files_are_listed(spark):
    rows = [(i, "error" if i % 3 == 0 else ("ok" if i % 7 else None), i + 0.5, datetime(2024, 1, 1 + i % 20)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = scratch_dir(spark, "observed-test")
    log, files = sinks.write_observed(df, path, F.col("kind_of") != "error", "value", "ts", "r1")
    (row,) = log.collect()
    valid = [r for r in rows if r[1] is not None and r[1] != "error"]
    assert (row.valid_rows, row.rejected_rows, row.new_rows) == (len(valid), 200 - len(valid), sum(int(r[2]) for r in valid))
    assert row.finished_at == max(r[3] for r in rows)
    listed = files.collect()
    assert row.files == len(listed) >= 2 and {f.kind for f in listed} == {"valid", "rejected"}
    back = spark.read.parquet(path).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in back} == {"valid": row.valid_rows, "rejected": row.rejected_rows}


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    log, files = sinks.write_observed(df, scratch_dir(spark, "observed-empty"), F.lit(True), "value", "ts", "r0")
    (row,) = log.collect()
    assert (row.valid_rows, row.rejected_rows, row.new_rows, row.finished_at, row.files) == (0, 0, None, None, 0)
    assert files.count() == 0
