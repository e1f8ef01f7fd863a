"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document's signature holds ``WIDTH`` minimum hashes of its word shingles,
16 bits each. Two documents at the similarity sought differ in about
``WIDTH * (1 - similarity)`` places; the distance threshold lies five standard
deviations above that. Signatures are cut into so many chunks that a pair
under the threshold has, by the pigeonhole principle, one chunk with at most
one error; each chunk is indexed once per place left out. So every pair under
the threshold meets in a bucket. Links are then confirmed on the full sets.

Groups of any size are handled without all their pairs. Documents with equal
sets are one class. In a few rounds each class is compared with its nearest
bucket head of another component, each round in a few of the places. Only then are the remaining pairs looked at:
pairs of different components, each in the first bucket it shares, large
buckets in blocks. Texts that meet each other in many buckets are compared as
one group instead, where that takes fewer rows. Pairs inside one component
need no look, because they cannot change it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import shuffle_width
from touchline.llm.components import components
from touchline.llm.tokens import ranges
from touchline.sources.scratch import passing, staged

WIDTH = 128
HEAD_ROUNDS = 5
ROUND_SLOTS = 8
BLOCK = 512
GROUP_ROUNDS = 2
WHOLE = -1
FINE = 4096
_DEVIATIONS = 5
_TEXTS = 500
_OFFERED = 65_536
_SEED = np.random.default_rng(20_240_601)
_FACTORS = _SEED.integers(0, 1 << 32, WIDTH, dtype=np.uint32) | np.uint32(1)
_PLACES = _SEED.integers(0, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_FINE_FACTORS = _SEED.integers(0, 1 << 32, FINE, dtype=np.uint32) | np.uint32(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Words per shingle and the least similarity, in percent, of two linked documents."""

    words: int = 5
    percent: int = 80

    @property
    def distance(self) -> int:
        """Most places in which the signatures of a linked pair may differ."""
        share = self.percent / 100
        return math.ceil(WIDTH * (1 - share) + _DEVIATIONS * math.sqrt(WIDTH * share * (1 - share)))

    @property
    def fine_distance(self) -> int:
        """The same for one bit of each of ``FINE`` further minimum hashes."""
        share = (1 - self.percent / 100) / 2
        return math.ceil(FINE * share + _DEVIATIONS * math.sqrt(FINE * share * (1 - share)))

    @property
    def chunks(self) -> list[np.ndarray]:
        """Places of each chunk: more than half the distance in number, so one has an error at most."""
        return np.array_split(np.arange(WIDTH), min(WIDTH, self.distance // 2 + 1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and the hashes of all words: A-Z lower-cased, cut at space and the controls 9 to 13."""
    import xxhash

    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = split.flatten().dictionary_encode()
    words = distinct.dictionary.to_pylist()
    codes = distinct.indices.to_numpy(zero_copy_only=False)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)[codes] if words else np.zeros(0, np.uint64)
    if "" in words:  # leading or trailing white space gives empty words
        filled = codes != words.index("")
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[filled], minlength=len(counts))
        hashes = hashes[filled]
    return counts, hashes


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words has none."""
    counts, hashes = word_hashes(texts)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        rolled = rolled * _STEP + hashes[i : i + len(rolled)]
    rolled = _mix(rolled)
    start = 0
    for count in counts.tolist():
        if count >= words:
            yield np.unique(rolled[start : start + count - words + 1])
        elif count:
            whole = np.array([count], np.uint64)
            for x in hashes[start : start + count]:
                whole = whole * _STEP + x
            yield _mix(whole + np.uint64(count))
        else:
            yield np.zeros(0, np.uint64)
        start += count


def signature(shingles: np.ndarray) -> np.ndarray:
    """``WIDTH`` minimum hashes, 16 bits of each."""
    high, lowest = (shingles >> np.uint64(32)).astype(np.uint32), np.full(WIDTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 4096):
        lowest = np.minimum(lowest, (high[at : at + 4096, None] * _FACTORS).min(axis=0))
    return ((lowest * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def fine_signature(shingles: np.ndarray) -> bytes:
    """One bit of each of ``FINE`` minimum hashes."""
    high, lowest = (shingles >> np.uint64(32)).astype(np.uint32), np.full(FINE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 128):
        lowest = np.minimum(lowest, (high[at : at + 128, None] * _FINE_FACTORS).min(axis=0))
    return np.packbits((lowest * np.uint32(0x85EBCA6B)) >> np.uint32(31)).tobytes()


def sketches(docs: DataFrame, rule: Rule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, set_hash, signature)``; the last two are null for empty sets."""
    kind = docs.schema[key].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(at, _TEXTS)
                sizes, hashes, marks = [], [], []
                for shingles in shingle_sets(batch.column(1), rule.words):
                    sizes.append(len(shingles))
                    hashes.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                    marks.append(signature(shingles).tobytes() if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(marks, pa.binary())],
                    ["key", "n_shingles", "set_hash", "signature"],
                )

    return docs.select(key, text).mapInArrow(sketch, f"key {kind}, n_shingles long, set_hash binary, signature binary")


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, WIDTH)


def bucket_keys(classes: DataFrame, rule: Rule) -> DataFrame:
    """``(bucket, slot, node)``: for each place left out of its chunk, a hash of the chunk's other places."""
    chunks = rule.chunks

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                values = _mix(_marks(batch.column(1)).astype(np.uint64) + _PLACES)
                buckets = np.empty_like(values)
                for chunk in chunks:
                    buckets[:, chunk] = values[:, chunk].sum(axis=1, keepdims=True) - values[:, chunk]
                buckets = _mix(buckets + _PLACES * _STEP)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets.reshape(-1).view(np.int64)),
                        pa.array(np.tile(np.arange(WIDTH, dtype=np.int16), batch.num_rows)),
                        batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), WIDTH))),
                    ],
                    ["bucket", "slot", "node"],
                )

    return classes.select("node", "signature").mapInArrow(index, "bucket long, slot short, node long")


@F.arrow_udf(T.IntegerType())
def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array((_marks(a) != _marks(b)).sum(axis=1).astype(np.int32))


def _shingles(text: str | None, words: int) -> frozenset:
    found = (text or "").encode().lower().split()
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False)) if len(found) >= words else frozenset([tuple(found)] if found else [])


def confirm(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are as similar as the rule asks. ``texts`` has ``(node, body)``."""
    words, percent = rule.words, rule.percent

    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        kept: dict = {}
        answers = []
        for left, right in zip(a.to_pylist(), b.to_pylist(), strict=True):
            if right not in kept:
                kept = {right: _shingles(right, words)}
            one, two = _shingles(left, words), kept[right]
            shared = len(one & two)
            answers.append(100 * shared >= percent * (len(one) + len(two) - shared))
        return pa.array(answers)

    body = lambda side: texts.select(F.col("node").alias(side), F.col("body").alias(f"text_{side}"))
    return pairs.join(body("a"), "a").join(body("b"), "b").where(alike("text_a", "text_b")).select("a", "b")


def _whole_groups(parts: DataFrame) -> DataFrame:
    """``parts`` (``bucket, n, slot, node, component``) with groups in place of buckets where that is less.

    Members of a large group of near copies meet in nearly all their buckets,
    so their signatures would travel, and each pair be compared, once per
    bucket. A group holds the nodes that reach the same smallest node in
    ``GROUP_ROUNDS`` steps. The buckets that lie in one group give way to it if
    it takes no more rows and pairs than they do; all others stay. So any two
    nodes that share a bucket share one afterwards or a group.
    """
    parts = staged(parts.select("bucket", "n", "slot", "node", "component"), "parts")
    group = parts.select("node", F.col("node").alias("group")).distinct()
    for _ in range(GROUP_ROUNDS):
        least = parts.join(group, "node").groupBy("bucket").agg(F.min("group").alias("group"))
        group = staged(parts.select("bucket", "node").join(least, "bucket").groupBy("node").agg(F.min("group").alias("group")), "groups")
    size = lambda c: F.col(c).cast("double")
    dealt = lambda c: size(c) * F.ceil(size(c) / BLOCK)
    within = parts.join(group, "node").groupBy("bucket").agg(F.min("group").alias("group"), F.max("group").alias("most"), F.first("n").alias("n"))
    within = staged(within.where("group = most").drop("most"), "within")
    cost = within.groupBy("group").agg(F.sum(dealt("n")).alias("rows"), F.sum(size("n") * size("n")).alias("pairs"))
    members = group.groupBy("group").agg(F.count(F.lit(1)).alias("m"))
    chosen = members.join(cost, "group").where((dealt("m") <= F.col("rows")) & (size("m") * size("m") <= F.col("pairs")))
    chosen = staged(chosen.select("group", "m"), "chosen")
    replaced = within.join(chosen, "group").select("bucket")
    nodes = parts.select("node", "component").distinct().join(group, "node").join(chosen, "group")
    whole = nodes.select(F.xxhash64("group").alias("bucket"), F.col("m").alias("n"), F.lit(WHOLE).cast("short").alias("slot"), "node", "component")
    return parts.join(replaced, "bucket", "left_anti").unionByName(whole)


def _residual(mixed: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of different components under the distance, each from the first bucket it shares.

    ``mixed`` has ``(bucket, low, high, own, slot, node, component, signature,
    fine)`` dealt out and sorted by the first three; ``own`` is the row's
    block. Groups (slot ``WHOLE``) give every pair. The fine signature keeps
    pairs that only just miss the similarity from the full comparison.
    """
    chunks, limit, fine_limit = rule.chunks, rule.distance, rule.fine_distance
    heads = np.array([c[0] for c in chunks])

    def pairs_of(rows: dict[str, np.ndarray], marks: np.ndarray, fine: np.ndarray) -> Iterator[np.ndarray]:
        group = np.stack([rows["bucket"], rows["low"], rows["high"]])
        n = group.shape[1]
        for step in range(1, n):
            first = np.flatnonzero((group[:, :-step] == group[:, step:]).all(axis=0))
            if not len(first):
                break
            second = first + step
            apart = (rows["low"][first] == rows["high"][first]) | (rows["own"][first] != rows["own"][second])
            apart &= rows["component"][first] != rows["component"][second]
            for at in range(0, len(first), 8192):
                keep = apart[at : at + 8192]
                a, b = first[at : at + 8192][keep], second[at : at + 8192][keep]
                differ = marks[a] != marks[b]
                near = (differ.sum(axis=1) <= limit) & (np.bitwise_count(fine[a] ^ fine[b]).sum(axis=1) <= fine_limit)
                a, b, differ = a[near], b[near], differ[near]
                errors = np.add.reduceat(differ, heads, axis=1, dtype=np.int64)
                chunk = np.argmax(errors <= 1, axis=1)
                begin = heads[chunk]
                slot = np.array([s + int(np.argmax(row[s : s + len(chunks[c])])) for s, c, row in zip(begin, chunk, differ, strict=True)], np.int64)
                once = (slot == rows["slot"][a]) | (rows["slot"][a] == WHOLE) if len(a) else np.zeros(0, bool)
                if once.any():
                    x, y = rows["node"][a[once]], rows["node"][b[once]]
                    yield np.stack([np.maximum(x, y), np.minimum(x, y)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for pairs in groups(batches):
            found.append(pairs)
            size += pairs.shape[1]
            if size >= _OFFERED:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)], ["a", "b"])
                found, size = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)], ["a", "b"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        names = ["bucket", "low", "high", "own", "slot", "node", "component"]
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = [held[c][-1].as_py() for c in names[:3]]
            open_ = np.logical_and.reduce([held[c].to_numpy() == v for c, v in zip(names[:3], last, strict=True)])
            done = int(np.argmax(open_))
            if done:
                ready, held = held.slice(0, done), held.slice(done)
                yield from pairs_of(*columns(ready))
        if held is not None and held.num_rows:
            yield from pairs_of(*columns(held))

    def columns(rows: pa.Table) -> tuple:
        fine = np.frombuffer(b"".join(rows["fine"].to_pylist()), np.uint64).reshape(-1, FINE // 64)
        names = ["bucket", "low", "high", "own", "slot", "node", "component"]
        return {c: rows[c].to_numpy().astype(np.int64) for c in names}, _marks(rows["signature"]), fine

    return mixed.mapInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, ``n_shingles``, ``component_id`` (smallest key reachable) and ``kept``.

    The key must be a whole number. Null and empty texts and texts without
    words have no shingles and are linked with nothing. Rows that share a key
    are one document, linked with each other; a row without a key is in no
    component, so its ``component_id`` is null, and it is kept. Other columns
    are left out. An empty table gives an empty table.
    """
    width = shuffle_width(docs.sparkSession)
    docs = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("body"))
    sketched = staged(sketches(docs, rule, "key", "body"), "sketches")
    filled = sketched.where("n_shingles > 0 AND key IS NOT NULL")
    grouped = filled.groupBy("set_hash").agg(F.min("key").alias("node"), F.first("signature").alias("signature"))
    classes = staged(grouped, "classes")

    keys = bucket_keys(classes, rule)
    shared = keys.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    shared = staged(keys.join(shared.select("bucket"), "bucket"), "buckets")
    nodes = shared.select("node").distinct()
    marks = staged(classes.join(nodes, "node").select("node", "set_hash", "signature"), "marks")
    texts = filled.join(marks.select("node", "set_hash"), "set_hash").where("key = node").select("node")
    bodies = docs.join(texts.distinct(), F.col("key") == F.col("node")).select("node", "body")
    bodies = staged(bodies.dropDuplicates(["node"]), "bodies")
    side = lambda c: marks.select(F.col("node").alias(c), F.col("signature").alias(f"mark_{c}"))

    same = filled.groupBy("key").agg(F.min("set_hash").alias("x"), F.max("set_hash").alias("y")).where("x <> y")
    versions = filled.join(same.select("key"), "key").join(classes, "set_hash").select(F.col("key").alias("a"), F.col("node").alias("b"))
    links = staged(versions, "links")

    def labelled(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The buckets with their components, and the components as links, which are stars already."""
        with passing(docs.sparkSession):  # the stored edges of all rounds of components
            found = staged(components(links), "stars", keep=True)
            joined = shared.join(found, shared["node"] == found["node"], "left").drop(found["node"])
            joined = staged(joined.withColumn("component", F.coalesce("component", "node")), "labelled", keep=True)
        return joined, found.select(F.col("node").alias("a"), F.col("component").alias("b"))

    def mixed_buckets(rows: DataFrame, seed: int) -> DataFrame:
        head = F.struct(F.xxhash64(F.col("node"), F.lit(seed)), "node", "component")
        grouped = rows.groupBy("bucket").agg(
            F.min("component").alias("x"), F.max("component").alias("y"), F.min(head).alias("head"), F.count(F.lit(1)).alias("n")
        )
        return grouped.where("x < y").select("bucket", "n", F.col("head.node").alias("b"), F.col("head.component").alias("of"))

    rows, links = labelled(links)
    for turn in range(HEAD_ROUNDS):
        # A few slots a round, so that a member of a large group meets a few heads and not one per bucket.
        some = rows.where(F.col("slot") % (WIDTH // ROUND_SLOTS) == turn)
        pairs = some.join(mixed_buckets(some, turn), "bucket").where("component <> of").select(F.col("node").alias("a"), "b")
        measured = pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", _distance("mark_a", "mark_b").alias("d"))
        nearest = measured.where(F.col("d") <= rule.distance).groupBy("a").agg(F.min(F.struct("d", "b")).alias("s"))
        found = staged(confirm(nearest.select("a", "s.b"), bodies, rule), "links")
        if found.isEmpty():
            continue
        rows, links = labelled(links.unionByName(found))

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")

    @F.arrow_udf(T.BinaryType())
    def fine(texts: pa.Array) -> pa.Array:
        return pa.array([fine_signature(x) for x in shingle_sets(texts, rule.words)], pa.binary())

    parts = _whole_groups(rows.join(mixed_buckets(rows, 0).select("bucket", "n"), "bucket"))
    left = parts.select("node").distinct()
    detail = marks.join(left, "node", "left_semi").join(bodies, "node").select("node", "signature", fine("body").alias("fine"))
    parts = parts.join(staged(detail, "detail"), "node")
    parts = parts.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    parts = parts.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "slot", "node", "component", "signature", "fine"
    )
    parts = parts.repartition(width, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    rest = staged(confirm(_residual(parts, rule).distinct(), bodies, rule), "links")
    final = components(links.unionByName(rest)).withColumnRenamed("node", "n")

    member = sketched.join(classes.select("set_hash", "node"), "set_hash", "left")
    member = member.join(final, F.col("node") == F.col("n"), "left")
    own = F.when(F.col("key").isNull(), F.lit(None)).otherwise(F.coalesce("component", "node", "key"))
    labelled_rows = member.select(F.col("key").alias(key), "n_shingles", own.cast("bigint").alias("component_id"))
    return labelled_rows.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


# The same from all pairs that share a shingle; three words and 85 percent.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
c AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 100 * k >= 85 * (cx.n + cy.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM c UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x)
SELECT c.doc_id, c.n AS n_shingles, min(r.other) AS component_id, c.doc_id = min(r.other) AS kept
FROM c JOIN r ON c.doc_id = r.doc_id GROUP BY c.doc_id, c.n
"""
