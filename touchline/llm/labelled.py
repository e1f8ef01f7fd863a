"""Bounded samples of labelled texts for fitting, and linear models fitted on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PER_GRADE = 2000
MAX_CHARS = 8192
_ALL = 2**64


def held_out(key: Column) -> Column:
    """Rows that no fit may see: CRC-32 of the key as text, divisible by five."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    per_grade: int = MAX_PER_GRADE,
    chars: int = MAX_CHARS,
) -> tuple[dict[int, list[str]], dict[int, int]]:
    """Texts to fit on, per grade, and how many labelled rows each grade has.

    At most ``per_grade`` texts of a grade, chosen by a hash of the key, and
    ``chars`` of each; held-out rows, null labels and null texts are left out.
    Only the fit is bounded so.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    marked = marked.select(F.col(key).alias("__llm_key"), F.col(label).cast("int").alias("__llm_grade")).distinct()
    counts = {r[0]: r[1] for r in marked.groupBy("__llm_grade").count().collect()}
    rank = F.xxhash64("__llm_key")
    chosen = None
    for grade, n in sorted(counts.items()):
        share = min(1.0, 2 * per_grade / n)
        limit = min(2**63 - 1, int((share - 0.5) * _ALL))  # about twice what is needed, so tasks send no more than that
        part = marked.where((F.col("__llm_grade") == grade) & (rank <= limit)).orderBy(rank, "__llm_key").limit(per_grade)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts: dict[int, list[str]] = {g: [] for g in counts}
    if chosen is not None:
        # The sample has a fixed bound per grade, so it is small enough for every executor.
        body = docs.select(F.col(key).alias("__llm_key"), F.substring(text, 1, chars).alias("__llm_body"))
        rows = body.join(F.broadcast(chosen), "__llm_key").where("__llm_body IS NOT NULL")
        for grade, _key, body_text in sorted((r["__llm_grade"], r["__llm_key"], r["__llm_body"]) for r in rows.collect()):
            texts[grade].append(body_text)
    return texts, counts


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words per text, the distinct words, and the number of the distinct word of each word; nulls have none."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = split.flatten().dictionary_encode()
    words, codes = distinct.dictionary.to_pylist(), distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in words:
        filled = codes != words.index("")
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[filled], minlength=len(counts))
        codes = codes[filled]
    return counts, words, codes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
