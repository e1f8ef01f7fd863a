"""Approximate nearest neighbours by cosine: NN-descent builds a graph, queries walk it greedily.

Equal vectors are one node; a node keeps its smallest ids, as many as an answer
can use. The graph starts from neighbours inside short blocks of vectors that
lie side by side along random directions. Each round then joins neighbours of
neighbours: every node gathers the vectors of some of its neighbours, in both
directions, compares them with each other, and offers each pair to its two
ends. A query starts at its own node, or at fixed entry nodes when it has
none, and goes on to the neighbours of the best nodes found until none of them
is left unexpanded. Answers are scored in double precision on the original vectors.

Lists per node are bounded, so a node that is near to very many others costs
no more than any other. That bound makes the method approximate, not its
coverage: every vector is a node, and every node gets neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import shuffle_width
from touchline.sources.scratch import staged

DEGREE = 32
SAMPLE = 24
ROUNDS = 8
ORDERINGS = 4
BLOCK = 384
PLANES = 6
BEAM = 160
BACK = 64
ENTRIES = 32
_SMALL = "node long, nbr long, sim float, fresh boolean"


def usable(vector: Column) -> Column:
    """True for vectors without nulls, with finite parts only, and not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 1), kind)


def _halves(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


@F.arrow_udf(T.BinaryType())
def _short(vectors: pa.Array) -> pa.Array:
    """Unit vectors in half precision, for building and walking the graph."""
    rows = _rows(vectors, np.float64)
    scale = np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)
    rows = rows / scale
    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return pa.array([r.tobytes() for r in rows.astype(np.float16)], pa.binary())


@F.arrow_udf(T.FloatType())
def _near(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array((_halves(a) * _halves(b)).sum(axis=1)) if len(a) else pa.array([], pa.float32())


@F.arrow_udf(T.DoubleType())
def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosine in double precision."""
    if not len(a):
        return pa.array([], pa.float64())
    x, y = _rows(a, np.float64), _rows(b, np.float64)
    lengths = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
    return pa.array((x * y).sum(axis=1) / lengths)


def nodes_of(vectors: DataFrame, members: int) -> DataFrame:
    """``(node, vector, short, ids)``: one row per distinct usable vector, with its ``members`` smallest ids.

    ``vectors`` has ``(id, vector)``. Vectors whose length is not the most
    common one take no part, because they have no cosine with the others.
    """
    good = vectors.where(usable(F.col("vector")) & F.col("id").isNotNull()).distinct()
    common = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    good = good.where(F.size("vector") == (common[0] if common else 0))
    ranked = good.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("at") <= members)
    grouped = ranked.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("node"), "vector", _short("vector").alias("short"), "ids")


def _top(edges: DataFrame, degree: int) -> DataFrame:
    """The best ``degree`` neighbours per node; an edge found before stays old."""
    once = edges.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    best = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    return once.withColumn("at", F.row_number().over(best)).where(F.col("at") <= degree).drop("at")


def _blocks(nodes: DataFrame, seed: int, degree: int) -> DataFrame:
    """Neighbours inside blocks of vectors with the same signs against some planes, ordered along one direction."""

    @F.arrow_udf("struct<code:int,along:float>")
    def placed(shorts: pa.Array) -> pa.Array:
        rows = _halves(shorts) if len(shorts) else np.zeros((0, 1), np.float32)
        planes = np.random.default_rng(seed).standard_normal((rows.shape[1], PLANES + 1)).astype(np.float32)
        along = rows @ planes
        code = ((along[:, :PLANES] > 0) << np.arange(PLANES)).sum(axis=1)
        return pa.StructArray.from_arrays([pa.array(code, pa.int32()), pa.array(along[:, PLANES])], ["code", "along"])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                rows, names = _halves(batch.column(1)), batch.column(0).to_numpy()
                n, k = len(names), min(degree, len(names) - 1)
                if k < 1:
                    continue
                sims = rows @ rows.T
                np.fill_diagonal(sims, -2)
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(names, k)),
                        pa.array(names[best].reshape(-1)),
                        pa.array(np.take_along_axis(sims, best, axis=1).reshape(-1)),
                        pa.array(np.ones(n * k, bool)),
                    ],
                    ["node", "nbr", "sim", "fresh"],
                )

    order = [F.col("place.code"), F.col("place.along")]
    dealt = nodes.select("node", "short", placed("short").alias("place"))
    dealt = dealt.repartitionByRange(shuffle_width(nodes.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.select("node", "short").mapInArrow(inside, _SMALL)


def _offers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per gathered list, each pair with a fresh member that would enter the list of one of its ends."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], []]
        lists = batch.column(0)
        members = lists.flatten()
        ids = members.field("m").to_numpy()
        worst, fresh = members.field("worst").to_numpy(), members.field("fresh").to_numpy(zero_copy_only=False)
        rows = _halves(members.field("short")) if len(ids) else np.zeros((0, 1), np.float32)
        start = 0
        for n in lists.value_lengths().to_pylist():
            part = slice(start, start + n)
            start += n
            if n < 2:
                continue
            own, new = rows[part], fresh[part]
            sims = own @ own.T
            wanted = (sims > worst[part][:, None]) & (new[:, None] | new[None])
            np.fill_diagonal(wanted, False)
            a, b = np.nonzero(wanted)
            names = ids[part]
            differ = names[a] != names[b]
            a, b = a[differ], b[differ]
            for kept, values in zip(out, (names[a], names[b], sims[a, b]), strict=True):
                kept.append(values)
        if out[0]:
            one, two, sim = (np.concatenate(x) for x in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one), pa.array(two), pa.array(sim.astype(np.float32)), pa.array(np.ones(len(one), bool))],
                ["node", "nbr", "sim", "fresh"],
            )


def build(nodes: DataFrame, degree: int = DEGREE, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """``(node, nbr, sim, fresh)``: the graph after ``rounds`` of NN-descent, or once a round changes one edge in 200."""
    shorts = nodes.select(F.col("node").alias("m"), "short")
    first = None
    for seed in range(ORDERINGS):
        part = _blocks(nodes, seed, degree)
        first = part if first is None else first.unionByName(part)
    graph = staged(_top(first, degree), "graph")
    for turn in range(rounds):
        draw = F.xxhash64("c", "m", F.lit(turn))
        ahead = graph.select(F.col("node").alias("c"), F.col("nbr").alias("m"), "fresh")
        back = graph.select(F.col("nbr").alias("c"), F.col("node").alias("m"), "fresh")
        pick = Window.partitionBy("c", "fresh").orderBy(draw)
        chosen = ahead.unionByName(back).groupBy("c", "m").agg(F.min("fresh").alias("fresh"))
        chosen = chosen.withColumn("at", F.row_number().over(pick)).where(F.col("at") <= F.when(F.col("fresh"), sample).otherwise(sample // 2))
        worst = graph.groupBy("node").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("n"))
        worst = worst.select(F.col("node").alias("m"), F.when(F.col("n") >= degree, F.col("low")).otherwise(-2.0).cast("float").alias("worst"))
        known = shorts.join(worst, "m", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0).cast("float")))
        gathered = chosen.join(known, "m").groupBy("c").agg(F.collect_list(F.struct("m", "worst", "fresh", "short")).alias("list"))
        offers = gathered.select("list").mapInArrow(_offers, _SMALL)
        # Members that were compared are old from now on.
        met = chosen.where("fresh").select(F.col("c").alias("node"), F.col("m").alias("nbr"), F.lit(True).alias("met"))
        seen = graph.join(met, ["node", "nbr"], "left").withColumn("fresh", F.col("fresh") & F.col("met").isNull()).drop("met")
        graph = staged(_top(seen.unionByName(offers), degree), "graph")
        state = graph.agg(F.count(F.lit(1)), F.sum(F.col("fresh").cast("int"))).first()
        if not state[0] or (state[1] or 0) < state[0] / 200:
            break
    return graph


def _links(graph: DataFrame, back: int = BACK) -> DataFrame:
    """``(node, nbr)``: all neighbours of a node, and the ``back`` nearest of those that have it as a neighbour."""
    near = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    reverse = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim")
    reverse = reverse.withColumn("at", F.row_number().over(near)).where(F.col("at") <= back)
    return graph.select("node", "nbr").unionByName(reverse.select("node", "nbr")).distinct()


def walk(starts: DataFrame, queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """``(query, node, sim)``: the ``beam`` best nodes found for each query.

    ``starts`` has ``(query, node)``, ``queries`` ``(query, q)`` with unit
    vectors in half precision. Each round expands the nodes of the beam that
    have not been expanded; the walk ends when there are none. It does end: no
    node enters a beam twice, and a beam only gets nearer.
    """
    shorts = nodes.select("node", "short")
    links = staged(_links(graph), "links")
    best = Window.partitionBy("query").orderBy(F.desc("sim"), "node")

    def measured(pairs: DataFrame) -> DataFrame:
        return pairs.join(shorts, "node").join(queries, "query").select("query", "node", _near("q", "short").alias("sim"))

    found = measured(starts.distinct()).withColumn("open", F.lit(True))
    found = staged(found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= beam).drop("at"), "walk")
    while True:
        todo = found.where("open").select("query", "node")
        if todo.isEmpty():
            break
        ahead = todo.join(links, "node").select("query", F.col("nbr").alias("node")).distinct()
        ahead = ahead.join(found.select("query", "node"), ["query", "node"], "left_anti")
        both = found.withColumn("open", F.lit(False)).unionByName(measured(ahead).withColumn("open", F.lit(True)))
        found = staged(both.withColumn("at", F.row_number().over(best)).where(F.col("at") <= beam).drop("at"), "walk")
    return found.select("query", "node", "sim")


def search(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for each query row: ``query_id``, ``rank``, key and ``score``, the exact cosine.

    Queries are the rows of ``vectors`` that ``is_query`` holds for; a query's
    own row is no candidate of its. Ties go to the smaller key. Rows with a
    null key or an unusable vector take no part. Repeated rows count once;
    other columns are left out; an empty table gives an empty table.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("asked"))
    nodes = staged(nodes_of(rows.select("id", "vector"), k + 1), "nodes")
    graph = build(nodes)
    asked = rows.where(F.col("asked") & F.col("id").isNotNull()).select("id", "vector").distinct()
    asked = staged(asked.join(nodes.select("node", "vector", "short"), "vector"), "queries")
    queries = asked.select(F.col("id").alias("query"), F.col("short").alias("q"))
    # In-table queries are nodes; the entry nodes serve parts of the graph that nothing links to them.
    entries = [r[0] for r in nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select("node").collect()]
    starts = asked.select(F.col("id").alias("query"), "node")
    if entries:
        beyond = asked.select(F.col("id").alias("query"), F.explode(F.lit(entries).cast("array<bigint>")).alias("node"))
        starts = starts.unionByName(beyond)
    found = walk(starts, queries, nodes, graph)
    scored = found.join(nodes.select("node", "vector", "ids"), "node")
    scored = scored.join(asked.select(F.col("id").alias("query"), F.col("vector").alias("own")), "query")
    scored = scored.select("query", "ids", cosine("own", "vector").alias("score"))
    each = scored.select("query", "score", F.explode("ids").alias("id")).where("id <> query")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score")
