"""Document fingerprints: bottom-k sketches of word shingles, built from SQL functions only.

A sketch is the sorted array of the ``k`` smallest distinct shingle hashes.
The smallest of a union are found among the smallest of its parts, so sketches
of parts merge into the sketch of the whole. Two sketches give estimates of
resemblance, containment and the number of distinct shingles, which are exact
while a document has fewer than ``k`` of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import shuffle_width

SIZE = 256
WORDS = 5
_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words in lower case; none for null and for white space alone."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), lambda w: w != "")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles_of(words: Column, n: int = WORDS) -> Column:
    """Hashes of the runs of ``n`` words; a shorter text is one run, an empty one has none."""

    def runs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        whole = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= n, every).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return _bound(words, runs)


def bottom(hashes: Column, k: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = SIZE, n: int = WORDS) -> Column:
    """Bottom-k sketch of a text; empty for null and for text without words."""
    return bottom(shingles_of(words_of(text), n), k)


def merge(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of what two sketches describe."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of common shingles in all of both, 0 to 1; two empty sketches are alike."""
    union = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(s: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of the first's shingles that the second has, 0 to 1; an empty sketch is in every other."""
    j, one, two = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    share = j * (one + two) / ((1 + j) * F.greatest(one, F.lit(1.0)))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def merge_parts(parts: DataFrame, *keys: str, column: str = "sketch", k: int = SIZE) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    Rows are cut to ``k`` hashes per key before the shuffle, so a key with
    very many parts stays small. Keys of empty sketches alone get an empty one.
    """
    one = parts.select(*keys, F.explode_outer(column).alias("__llm_hash")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.col("__llm_hash").asc_nulls_last())
    kept = one.withColumn("__llm_n", F.row_number().over(order)).where(F.col("__llm_n") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("__llm_hash")).alias(column))


def to_text(s: Column) -> Column:
    """A sketch as a string: its hashes in hexadecimal, joined by dots."""
    return F.array_join(F.transform(s, lambda h: F.hex(h)), ".")


def from_text(s: Column) -> Column:
    """The sketch of :func:`to_text`."""
    parts = F.filter(F.split(s, r"\."), lambda x: x != "")
    unsigned = F.transform(parts, lambda x: F.conv(x, 16, -10).cast("bigint"))
    return F.sort_array(unsigned)


def with_next(docs: DataFrame, key: str, text: str, following: str) -> DataFrame:
    """``docs`` with the text of the next row in descending ``key`` order; the last is followed by the first.

    Rows are dealt into key ranges that lie between quantiles, one shuffle of
    the texts in all; the first row of each range is joined to the range
    before it. Null keys come last; equal keys are ordered by their text.
    """
    count = 4 * shuffle_width(docs.sparkSession)
    steps = [i / count for i in range(1, count)]
    # As many numbers as ranges, so their list does not grow with the table.
    bounds = docs.agg(F.percentile_approx(key, steps, 10_000)).first()[0] or []
    edges = F.lit(sorted(set(bounds))) if bounds else F.array().cast("array<bigint>")
    place = F.size(F.filter(edges, lambda e: e < F.col(key)))
    docs = docs.withColumn("__llm_range", F.when(F.col(key).isNull(), -1).otherwise(place))

    order = [F.col(key).desc_nulls_last(), F.col(text).desc()]
    after = F.lead(text).over(Window.partitionBy("__llm_range").orderBy(*order))
    top = F.max(F.struct(key, text))[text].alias("__llm_top")
    heads = docs.groupBy("__llm_range").agg(top)
    # One row per range.
    down = Window.orderBy(F.col("__llm_range").desc())
    around = Window.orderBy(F.col("__llm_range").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turned = F.coalesce(F.lead("__llm_top").over(down), F.first("__llm_top").over(around))
    heads = heads.select("__llm_range", turned.alias("__llm_other"))
    joined = docs.withColumn(following, after).join(heads, "__llm_range", "left")
    return joined.withColumn(following, F.coalesce(following, "__llm_other")).drop("__llm_range", "__llm_other")


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edit replaces the last half of the code points by the first as many of
    the next text in descending key order. A null text counts as empty. Rows
    may repeat; other columns are left out; an empty table gives an empty table.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = with_next(rows, key, "body", "after").withColumn("n_chars", F.length("body").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("body", F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring("after", F.lit(1), half)))
    rows = rows.select(
        key,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("body")).alias("own"),
        sketch(F.col("edited")).alias("other"),
        sketch(F.col("after")).alias("following"),
    )
    own, other, following = F.col("own"), F.col("other"), F.col("following")
    return rows.select(
        key,
        "n_chars",
        "edited_sha256",
        to_text(own).alias("fingerprint"),
        to_text(other).alias("edited_fingerprint"),
        resemblance(own, other).alias("near_edited"),
        resemblance(own, following).alias("near_next"),
        distinct_shingles(own).alias("distinct_shingles"),
        containment(own, other).alias("kept_in_edited"),
    )
