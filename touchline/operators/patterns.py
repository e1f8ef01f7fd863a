"""Many text patterns at once: an n-gram inverted index joined with the texts, then verified.

A pattern is found in a text when it occurs in it as written (``contains``,
the meaning of ``LIKE '%pattern%'`` for patterns without wildcards). Every
pattern is looked up by one of its n-grams, the one that fewest texts hold
(counted only for n-grams that some pattern has), so candidates stay few; a
pattern shorter than ``GRAM`` is its own gram. Candidate pairs come from one
equi-join on the gram, where each gram's row of patterns is copied ``SALT``
times so that a gram held by very many texts is spread over as many tasks, and
every candidate is verified on the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
SALT = 16


def _grams(text: str, sizes: list[int]):
    """Distinct substrings of the given sizes of ``text``."""
    column, length = F.col(text), F.char_length(text)
    empty = F.array().cast("array<string>")

    def cut(size: int):
        return lambda i: F.substring(column, i, F.lit(size))

    grams = [F.when(length >= size, F.transform(F.sequence(F.lit(1), length - size + 1), cut(size))).otherwise(empty) for size in sizes]
    return F.array_distinct(F.flatten(F.array(*grams)))


def matches(texts: DataFrame, text_id: str, text: str, patterns: DataFrame, pattern_id: str, pattern: str) -> DataFrame:
    """Pairs (``text_id``, ``pattern_id``) where the pattern occurs in the text.

    Null or empty patterns and null texts match nothing. Repeated texts or
    patterns give repeated pairs.
    """
    wanted = patterns.where(F.char_length(pattern) > 0).select(F.col(pattern_id).alias("__pid"), F.col(pattern).alias("__pat"))
    sizes = sorted({GRAM, *[r[0] for r in wanted.select(F.least(F.char_length("__pat"), F.lit(GRAM))).distinct().collect()]})
    short = F.array(F.col("__pat"))
    own = wanted.select("__pid", "__pat", F.explode(F.when(F.char_length("__pat") >= GRAM, _grams("__pat", [GRAM])).otherwise(short)).alias("__gram"))
    kinds = own.select("__gram").distinct()
    held = texts.where(F.col(text).isNotNull()).select(F.col(text_id).alias("__tid"), F.col(text).alias("__text"))
    held = held.select("__tid", "__text", F.explode(_grams("__text", sizes)).alias("__gram")).join(kinds, "__gram", "left_semi")
    counts = held.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = own.join(counts, "__gram").groupBy("__pid", "__pat").agg(F.min(F.struct("__n", "__gram")).alias("__best"))
    chosen = rarest.select("__pid", "__pat", F.col("__best.__gram").alias("__gram"))
    copies = chosen.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    spread = held.withColumn("__salt", F.pmod(F.xxhash64("__tid", "__text"), F.lit(SALT)))
    found = spread.join(copies, ["__gram", "__salt"]).where(F.contains("__text", "__pat"))
    return found.select(F.col("__tid").alias(text_id), F.col("__pid").alias(pattern_id))
