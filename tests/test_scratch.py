import os
import uuid

import pytest
from pyspark.sql import functions as F

from touchline.sources import scratch


def shuffle_bytes(spark):
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(
        os.path.getsize(os.path.join(folder, name))
        for top in root
        for folder, _below, names in os.walk(top)
        for name in names
        if name.startswith("shuffle_") and name.endswith(".data")
    )


def test_staging_leaves_no_shuffle_files(spark):
    before = spark.conf.get(scratch._CLEANUP, None)
    was = shuffle_bytes(spark)
    rows = spark.range(500_000).withColumn("x", F.xxhash64("id")).repartition(4, "x")
    assert scratch.staged(rows, "shuffled").count() == 500_000
    assert shuffle_bytes(spark) - was < 1_000_000  # the shuffle itself takes about 8 MB
    assert spark.conf.get(scratch._CLEANUP, None) == before


@pytest.fixture
def below(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_dir", lambda _spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    return tmp_path


def folders(path):
    return {f.name.rsplit("-", 1)[0] for f in path.iterdir()}


def test_tables_on_the_way_go_when_their_block_ends(spark, below):
    before = scratch.staged(spark.range(3), "before")
    with scratch.passing(spark):
        outer = scratch.staged(before, "outer")
        with scratch.passing(spark):
            inner = scratch.staged(outer, "inner")
            middle = scratch.staged(inner, "middle", keep=True)
        assert folders(below) == {"before", "outer", "middle"}
        last = scratch.staged(middle.unionByName(outer), "last", keep=True)
    assert folders(below) == {"before", "last"}
    assert before.count() == 3 and last.count() == 6


def test_stages_of_the_pipeline_leave_their_result_alone(spark, below):
    import corpus_pipeline

    def stage(spark, docs, sf_dir):
        return scratch.staged(docs.where("id > 0"), "on-the-way").where("id > 1")

    _name, run_stage = corpus_pipeline.stored("a stage", stage)
    assert [r.id for r in run_stage(spark, spark.range(3), "").collect()] == [2]
    assert folders(below) == {"a-stage"}


def test_staged_texts_are_compressed_by_zstandard(spark, below):
    import pyarrow.parquet as pq

    scratch.staged(spark.range(3), "rows")
    files = [pq.ParquetFile(f).metadata for f in below.rglob("*.parquet")]
    assert {f.row_group(0).column(0).compression for f in files if f.num_rows} == {"ZSTD"}
