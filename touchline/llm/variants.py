"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One inserted, deleted or replaced letter changes a word's letter counts by at
most two in L1 (one for an insertion or deletion), and each count by at most
one. So for every length L a k-d tree over the count vectors of the words of
length L is searched with the words of length L (box of one around the query,
at most two crossings) and those of length L - 1 (one crossing); candidates
within L1 two are verified letter by letter.

Plan. The top levels of each tree are built in Spark: each round, every cell
with more than ``CELL_WORDS`` words picks the letter and count threshold that
split it most evenly (from a histogram, combined before the shuffle), and its
words move to the two children. Queries walk the same splits: to their own side
and, while crossings are left, across a split their box reaches. Each leaf cell
then meets its queries in one task, which builds a k-d tree over at most
``CELL_WORDS`` vectors (more only for words with equal letter counts, which
cannot be split) and searches it with all its queries at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.sources.scratch import staged

# Values fixed by the contract of the query.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 31
MIN_LENGTH, MIN_COUNT, FORM_FACTOR = 7, 2, 10
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))  # dimensions of the count vectors; A-Z never remain

#: Most words of a leaf cell of the distributed tree.
CELL_WORDS = 2048
#: Copies of a small table of splits, so that a hot cell meets them in as many tasks.
SALT = 32
#: Points in a leaf of the local k-d tree, and queries compared with a leaf at once.
LEAF_POINTS = 16
LEAF_QUERIES = 2048
#: Counts up to here are told apart by the bits that leaves are compared with first.
BIT_LEVELS = 3
#: Letters of candidate pairs compared at once.
PAIR_LETTERS = 1 << 22
#: Leaf cells of the distributed tree handed to one call of Python, on average.
CELLS_PER_TASK = 16


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of at least MIN_LENGTH code points seen at least MIN_COUNT times: (word, n).

    Runs of letters of whole texts, A-Z lower-cased; where DROP_EVERY divides
    the unsigned crc32 of ``<doc_id>:<run>``, the run loses its code point
    crc % length. A null text has no runs; a null doc_id drops nothing.
    """
    runs = docs.select(F.col(doc_id).cast("string").alias("__llm_doc"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), 0)).alias("__llm_run"))
    run = F.translate("__llm_run", UPPER, LOWER)
    h = F.crc32(F.concat(F.col("__llm_doc"), F.lit(":"), run).cast("binary"))
    at = h % F.char_length(run)
    cut = F.concat(F.substring(run, 1, at.cast("int")), F.substring(run, (at + 2).cast("int"), 1 << 30))
    word = F.when(h % DROP_EVERY == 0, cut).otherwise(run)
    words = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where((F.char_length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def _letter_counts(word: Column) -> Column:
    """Map letter -> count of a word."""
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    return F.aggregate(
        letters, F.create_map().cast("map<string,int>"),
        lambda acc, c: F.map_concat(F.map_filter(acc, lambda k, v: k != c), F.create_map(c, F.coalesce(acc[c], F.lit(0)) + 1)),
    )


def _salted(many: DataFrame, few: DataFrame, keys: list[str], salt_of: Column) -> DataFrame:
    """Left join of ``many`` to ``few`` (one row per key); ``few`` is copied SALT times so a hot key spreads."""
    few = few.withColumn("__llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    many = many.withColumn("__llm_salt", F.pmod(salt_of, F.lit(SALT)))
    return many.join(few, [*keys, "__llm_salt"], "left").drop("__llm_salt")


def _splits(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Top levels of the trees: (points with their leaf cell, splits (length, cell, letter, at))."""
    spark = points.sparkSession
    splits = spark.createDataFrame([], "length int, cell long, letter string, at int")
    points = staged(points.withColumn("cell", F.lit(1).cast("long")), "variants-cells")
    while True:
        sizes = points.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL_WORDS)
        counts = points.join(sizes, ["length", "cell"], "left_semi").select("length", "cell", F.explode("counts").alias("letter", "c"))
        hist = counts.groupBy("length", "cell", "letter", "c").agg(F.count(F.lit(1)).alias("k"))
        hist = hist.join(sizes, ["length", "cell"])
        # A threshold one below each count present: words with fewer of the letter (absent ones too) go left.
        from_top = Window.partitionBy("length", "cell", "letter").orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("left", F.col("size") - F.sum("k").over(from_top)).withColumn("c", F.col("c") - 1)
        balance = F.least(F.col("left"), F.col("size") - F.col("left"))
        best = hist.where(balance > 0).groupBy("length", "cell").agg(F.max(F.struct(balance.alias("b"), F.col("letter"), F.col("c"))).alias("s"))
        best = staged(best.select("length", "cell", F.col("s.letter").alias("letter"), F.col("s.c").cast("int").alias("at")), "variants-splits")
        if best.isEmpty():
            return points, splits
        splits = splits.unionByName(best)
        moved = _salted(points, best, ["length", "cell"], F.xxhash64("word"))
        side = (F.coalesce(F.col("counts")[F.col("letter")], F.lit(0)) > F.col("at")).cast("long")
        cell = F.when(F.col("letter").isNull(), F.col("cell")).otherwise(F.col("cell") * 2 + side)
        points = staged(moved.select("word", "n", "length", "counts", cell.alias("cell")), "variants-cells")


def _routes(queries: DataFrame, splits: DataFrame) -> DataFrame:
    """Leaf cells each query's box reaches: its own side at each split, the other where one more or one
    fewer of the split letter takes it there, while such steps are left (``ups``, ``downs``)."""
    splits = staged(splits, "variants-all-splits")
    routes = queries.withColumn("cell", F.lit(1).cast("long"))
    done = None
    while True:
        routes = staged(_salted(routes, splits, ["length", "cell"], F.xxhash64("query", "cell")), "variants-routes")
        leaf = routes.where(F.col("letter").isNull()).drop("letter", "at")
        done = leaf if done is None else done.unionByName(leaf)
        inner = routes.where(F.col("letter").isNotNull())
        if inner.isEmpty():
            return done
        c = F.coalesce(F.col("qcounts")[F.col("letter")], F.lit(0))
        own = (c > F.col("at")).cast("long")
        # Left to right needs one more of the letter, right to left one fewer: each edit allows one of each at most.
        up = (own == 0) & (c == F.col("at")) & (F.col("ups") > 0)
        down = (own == 1) & (c == F.col("at") + 1) & (F.col("downs") > 0)
        steps = F.when(up | down, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        routes = inner.select("*", F.explode(steps).alias("cross")).select(
            "query", "qcounts", "length", "delete",
            (F.col("cell") * 2 + F.when(F.col("cross") == 1, 1 - own).otherwise(own)).alias("cell"),
            (F.col("ups") - F.when((F.col("cross") == 1) & (own == 0), 1).otherwise(0)).alias("ups"),
            (F.col("downs") - F.when((F.col("cross") == 1) & (own == 1), 1).otherwise(0)).alias("downs"),
        )


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point between ``a`` and ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


_DIMENSION = np.full(0x100, -1, dtype=np.int64)
_DIMENSION[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def _vectors(words: list[str]) -> np.ndarray:
    """Letter counts, one row per word (all letters lie below U+0100)."""
    out = np.zeros((len(words), len(ALPHABET)), dtype=np.int16)  # counts of very long words exceed a byte
    if words:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        np.add.at(out, (np.repeat(np.arange(len(words)), lengths), _DIMENSION[codes]), 1)
    return out


def _bits(counts: np.ndarray) -> np.ndarray:
    """Unary code of each row: one bit per letter and level that its count reaches, as 64-bit words.

    Rows differ in at least as many counts as in bits, so bits never rule out a near row.
    """
    reached = np.concatenate([counts >= level for level in range(1, BIT_LEVELS + 1)], axis=1)
    packed = np.packbits(reached, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def kd_search(points: np.ndarray, queries: np.ndarray, downs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of ``_kd_pairs`` as tuples."""
    return list(zip(*(x.tolist() for x in _kd_pairs(points, queries, downs)), strict=True))


def _kd_pairs(points: np.ndarray, queries: np.ndarray, downs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) where the point has at most one count one higher and at most ``downs`` (0 or 1)
    counts one lower than the query, all others equal: what one edit can do. Found by a k-d tree.

    Points of one cell have one length and queries that length (``downs`` 1)
    or one less (``downs`` 0); then L1 <= 1 + downs already says all that.

    Each node splits on its widest dimension at the median; all queries walk
    the tree together and enter the other child only where one more (or one
    fewer) of that letter takes them there and such a step is left. Leaves
    compare a bounded number of queries at a time, by bits first and the few
    that are left by counts.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    points_bits, queries_bits = _bits(points), _bits(queries)
    n = len(queries)
    stack = [(np.arange(len(points)), np.arange(n), np.ones(n, dtype=np.int8), downs.astype(np.int8))]
    while stack:
        members, asking, ups_left, downs_left = stack.pop()
        if len(members) == 0 or len(asking) == 0:
            continue
        box = points[members]
        spread = box.max(axis=0) - box.min(axis=0)
        if len(members) <= LEAF_POINTS or spread.max() == 0:
            for lo in range(0, len(asking), LEAF_QUERIES):
                chunk = asking[lo : lo + LEAF_QUERIES]
                far = np.zeros((len(chunk), len(members)), np.int16)
                for one, two in zip(queries_bits[chunk].T, points_bits[members].T, strict=True):
                    far += np.bitwise_count(one[:, None] ^ two[None])
                qi, pi = np.nonzero(far <= 1 + downs[chunk][:, None])
                q, p = chunk[qi], members[pi]
                near = np.abs(points[p] - queries[q]).sum(axis=1) <= 1 + downs[q]
                found.append((q[near], p[near]))
            continue
        dim = int(spread.argmax())
        at = int(np.median(box[:, dim]))
        if box[:, dim].max() <= at:
            at -= 1
        left = box[:, dim] <= at
        c = queries[asking, dim]
        own_left = c <= at
        # Stay on the own side, or step over with one more (to the right) or one fewer (to the left).
        stay = np.ones(len(asking), dtype=bool)
        step_up = own_left & (c == at) & (ups_left > 0)
        step_down = ~own_left & (c == at + 1) & (downs_left > 0)
        for go_left, part in ((True, members[left]), (False, members[~left])):
            own = own_left == go_left
            ok = np.where(own, stay, step_up if not go_left else step_down)
            ups = ups_left - (~own & ~go_left)
            dns = downs_left - (~own & go_left)
            stack.append((part, asking[ok], ups[ok].astype(np.int8), dns[ok].astype(np.int8)))
    q, p = (np.concatenate(x) for x in zip(*found, strict=True))
    return q, p


def _letters(words: list[str], length: int) -> np.ndarray:
    """One row of code points per word, filled up with zeros."""
    return np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length)


def _one_edits(asked: list[str], words: list[str], q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``one_edit`` of every pair: words have one length, asked ones that length or one less."""
    length = len(words[0])
    left, right = _letters(asked, length), _letters(words, length)
    shorter = np.fromiter(map(len, asked), np.int64, len(asked)) < length
    good = np.zeros(len(q), bool)
    step = max(1, PAIR_LETTERS // length)
    for lo in range(0, len(q), step):
        part = slice(lo, lo + step)
        a, b, less = left[q[part]], right[p[part]], shorter[q[part]]
        ahead, behind = a == b, a[:, :-1] == b[:, 1:]
        # Letters that agree from the front, and from the back beside one more letter of the word.
        front = np.where(ahead[:, :-1].all(axis=1), length - 1, ahead.argmin(axis=1))
        back = np.where(behind.all(axis=1), length - 1, behind[:, ::-1].argmin(axis=1))
        good[part] = np.where(less, front + back >= length - 1, (~ahead).sum(axis=1) == 1)
    return good


def _leaf_pairs(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if points.empty or queries.empty:
        return pd.DataFrame({"word": pd.Series(dtype=str), "near": pd.Series(dtype=str)})
    queries = queries.drop_duplicates("query")
    words, asked = points["word"].tolist(), queries["query"].tolist()
    points_at, asked_at = _vectors(words), _vectors(asked)
    used = points_at.any(axis=0) | asked_at.any(axis=0)  # letters absent from the whole cell change no distance
    q, p = _kd_pairs(points_at[:, used], asked_at[:, used], queries["delete"].to_numpy(dtype=np.int8))
    good = _one_edits(asked, words, q, p)
    kept = [(asked[i], words[j]) for i, j in zip(q[good].tolist(), p[good].tolist(), strict=True)]
    return pd.DataFrame(kept, columns=["word", "near"], dtype=str)


def _bucket_pairs(points: pd.DataFrame, routes: pd.DataFrame) -> pd.DataFrame:
    """Pairs of every cell in a bucket, one cell at a time."""
    asked = {key: part for key, part in routes.groupby(["length", "cell"])} if not routes.empty else {}
    found = [_leaf_pairs(part, asked[key]) for key, part in points.groupby(["length", "cell"]) if key in asked]
    return pd.concat(found, ignore_index=True) if found else _leaf_pairs(points.iloc[:0], routes.iloc[:0])


def near_pairs(words: DataFrame) -> DataFrame:
    """Both directions of every pair of words one edit apart: (word, near)."""
    points = words.select("word", "n", F.char_length("word").alias("length"), _letter_counts(F.col("word")).alias("counts"))
    points, splits = _splits(points)
    base = points.select(F.col("word").alias("query"), F.col("counts").alias("qcounts"), "length")
    # Same length: a substitution, one letter more and one fewer. One shorter: the query is the shorter word, one letter more.
    same = base.withColumn("delete", F.lit(1))
    longer = base.withColumn("length", F.col("length") + 1).withColumn("delete", F.lit(0))
    queries = same.unionByName(longer).withColumn("ups", F.lit(1)).withColumn("downs", F.col("delete"))
    # A call of Python takes about CELLS_PER_TASK cells, and no cell without words: many lengths hold only a few.
    cells = points.select("length", "cell").distinct()
    spread = max(1, cells.count() // CELLS_PER_TASK)
    bucket = F.pmod(F.xxhash64("length", "cell"), F.lit(spread)).alias("__llm_bucket")
    routes = _routes(queries, splits).select("length", "cell", "query", "delete").join(cells, ["length", "cell"], "left_semi")
    found = points.select(bucket, "length", "cell", "word").groupBy("__llm_bucket").cogroup(
        routes.select(bucket, "length", "cell", "query", "delete").groupBy("__llm_bucket")
    ).applyInPandas(_bucket_pairs, "word string, near string")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def variant_forms(docs: DataFrame) -> DataFrame:
    """Per word: its form, root, count, near-word count and the form's count.

    A word's form is its near word of largest count (ties: smallest in
    code-point order) if that count is at least FORM_FACTOR times its own; else
    null. The root follows forms to the last (the word itself if it has none);
    as each form's count is ten times larger, chains are short and end. Empty
    or null texts give no words; an empty table no rows; extra columns are ignored.
    """
    words = staged(word_counts(docs), "variants-words")
    pairs = near_pairs(words)
    counted = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("b"))
    table = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.m") >= FORM_FACTOR * F.col("n"), F.col("b.near")).alias("form"),
        F.when(-F.col("b.m") >= FORM_FACTOR * F.col("n"), -F.col("b.m")).cast("long").alias("form_n"),
    )
    table = staged(table, "variants-forms")
    # Pointer jumping: each round the root moves to its own form's root.
    roots = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        step = roots.alias("a").join(roots.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word"), F.coalesce(F.col("b.root"), F.col("a.root")).alias("root"), (F.col("b.root") != F.col("a.root")).alias("moved")
        )
        step = staged(step, "variants-roots")
        if step.where(F.col("moved")).isEmpty():
            break
        roots = step.drop("moved")
    return table.join(step.drop("moved"), "word").select("word", "form", "root", "n", "n_near", "form_n")
