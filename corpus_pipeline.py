"""Cleaning of a document table in stages, each one operator of ``touchline.llm``.

A stage gets the rows that its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Models are fitted on the
labelled rows of the whole table, without held-out ones. Rows with a null text
count as empty ones; the quality model decides on them like on any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm import catalog, near_dup, packing, quality, toxicity, unit_dedup
from touchline.llm.common import short_batches, table
from touchline.sources.scratch import passing, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
END_ID = 0


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is one half or more."""
    model = quality.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rated = docs.withColumn("__llm_rate", quality.graded(model, docs))
    return rated.where(F.col("__llm_rate.top_probability") >= quality.THRESHOLD).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of toxicity is below one half."""
    model = toxicity.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.withColumn("__llm_score", toxicity.score(model, docs)).where("__llm_score < 0.5").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; of repeated rows one. Rows without id stay."""
    found = near_dup.near_duplicates(docs, near_dup.Rule())
    kept = docs.join(found.where("kept").select("doc_id").distinct(), "doc_id", "left_semi")
    rows = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    kept = kept.withColumn("__llm_row", F.row_number().over(rows)).where("__llm_row = 1").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; ``n_chars`` follows. A text of which nothing is left goes."""
    freed = unit_dedup.remove_repeats(docs)
    left = freed.where((F.size("removed") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\f\r")) != ""))
    if "n_chars" in docs.columns:
        count = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents, each with its sequence and offset."""
    return packing.pack_documents(docs, catalog.tokenizer_file(catalog.BYTE_BPE), END_ID)


def stored(name: str, stage: Stage) -> tuple[str, Stage]:
    """The stage with its result stored before anyone reads it.

    While it runs, also alone, Arrow batches to Python are short, so a batch
    of long documents stays small in every Python worker. Tables staged on the
    way go once the result is stored, which reads none of them.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with short_batches(spark), passing(spark):
            return staged(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)

    return name, run_stage


STAGES: list[tuple[str, Stage]] = [
    stored("quality classifier", good_quality),
    stored("toxicity", not_toxic),
    stored("minhash near-dedup", one_of_near_copies),
    stored("substring dedup", without_repeats),
    stored("best-fit packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
