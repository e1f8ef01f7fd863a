"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, fingerprints, merkle, near_dup, neighbours, packing, quality, token_files, toxicity, unit_dedup, url_rules, variants, warc
from touchline.llm.common import short_batches, table
from touchline.sources.scratch import scratch_dir, staged

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))
    with short_batches(spark):  # the small result is stored, so that the setting holds while the texts are coded
        return staged(digests, "token-digests")


def op2_bottom_k_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def op3_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    freed = unit_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return freed.select("doc_id", "text", "removed", F.size("removed").cast("bigint").alias("n_removed"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), end_id=0)


def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = near_dup.Rule(words=3, percent=85)  # fixed by the contract of the query
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), rule)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op7_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    return token_files.digests(table(spark, sf_dir, "documents"), folder, tokenizer_file(BYTE_BPE), end_id=2)


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_forms(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_tree_bpe,
        op2_bottom_k_fingerprint,
        op3_unit_dedup,
        op4_best_fit_packing,
        op5_minhash_near_dup,
        op6_url_filter,
        op7_compression_toxicity,
        op8_token_files,
        op9_nn_descent,
        op10_ordinal_quality,
        op11_warc_archives,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {"op5_minhash_near_dup": near_dup.ORACLE_SQL, "op6_url_filter": url_rules.ORACLE_SQL}
