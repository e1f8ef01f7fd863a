"""Classifiers by held-out accuracy, neighbours by recall, and the pipeline by its parts."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import catalog, labelled, near_dup, neighbours, packing, quality, toxicity

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def labels(spark, column):
    return {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_op7_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op7_compression_toxicity"](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held(k) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for k, r in rows.items())
    known = [(rows[k]["predicted"], v) for k, v in labels(spark, "toxic").items() if held(k) and k in rows]
    assert np.mean([a == b for a, b in known]) >= 0.95


def test_op10_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op10_ordinal_quality"](spark, SF).collect()}
    assert all(r["held_out"] == held(k) and r["kept"] == (r["top_probability"] >= 0.5) for k, r in rows.items())
    known = [(rows[k]["kept"], v == 1) for k, v in labels(spark, "quality").items() if held(k) and k in rows]
    assert np.mean([a == b for a, b in known]) >= 0.95


def test_thresholds_rise_with_three_grades():
    draw = random.Random(2)
    words = {0: ["AAA!!", "BB!!"], 1: ["AAA!!", "plain", "words"], 2: ["plain", "words", "here"]}
    texts = {g: [" ".join(draw.choices(w, k=30)) for _ in range(60)] for g, w in words.items()}
    model = quality.fit(texts, {g: 60 for g in texts})
    assert np.all(np.diff(model.thresholds) > 0) and model.grades == (0, 1, 2)
    import pyarrow as pa

    means = [model.grade(model.sums(pa.array(texts[g])))[0].mean() for g in (0, 1, 2)]
    assert means[0] < 0.6 < means[1] < 1.5 < means[2]


@pytest.mark.parametrize("run", [toxicity.classify, quality.rate])
def test_classifiers_on_odd_rows(spark, odd_docs, run):
    marked = [(i, i % 2, i % 2) for i in range(15)] + [(3, None, None), (None, 1, 1), (99, 0, 0)]
    rated = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    assert run(odd_docs, rated).count() == odd_docs.count()
    assert run(odd_docs, rated.limit(0)).count() == odd_docs.count()
    assert run(odd_docs.limit(0), rated).count() == 0


def test_samples_leave_held_out_rows_out(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts, counts = labelled.sample(docs, marks, "toxic", per_grade=20)
    assert {g: len(t) for g, t in texts.items()} == {0: 20, 1: 20}
    own = {r["text"]: r["doc_id"] for r in docs.collect()}
    assert not any(held(own.get(t, 1)) for t in texts[0] + texts[1] if len(t) < 8192)
    assert sum(counts.values()) == sum(not held(k) for k in labels(spark, "toxic"))


def exact(vectors, queries, k):
    keys = np.array(sorted(vectors))
    rows = np.array([vectors[i] for i in keys], float)
    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    for q in queries:
        sims = rows @ rows[np.searchsorted(keys, q)]
        order = [i for i in np.lexsort((keys, -np.round(sims, 12))) if keys[i] != q][:k]
        yield q, [(int(keys[i]), sims[i]) for i in order]


def test_op9_recall(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = {}
    for row in catalog.QUERIES["op9_nn_descent"](spark, SF).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    queries = [i for i in vectors if i % 50 == 0]
    assert sorted(got) == sorted(queries)
    hits = 0
    for q, best in exact(vectors, queries, 5):
        answer = sorted(got[q])
        assert [a[0] for a in answer] == [1, 2, 3, 4, 5]
        assert [(-s, v) for _, v, s in answer] == sorted((-s, v) for _, v, s in answer)
        hits += len({v for _, v, _ in answer} & {v for v, _ in best})
    assert hits / (5 * len(queries)) >= 0.9


def test_hubs_keep_their_own_neighbours(spark):
    own = [(0, i, 0.9, False) for i in range(1, 33)]
    reverse = [(i, 0, i / 1e4, False) for i in range(100, 3000)]
    graph = spark.createDataFrame(own + reverse, "node long, nbr long, sim float, fresh boolean")
    got = {r["nbr"] for r in neighbours._links(graph).where("node = 0").collect()}
    assert got == set(range(1, 33)) | set(range(3000 - neighbours.BACK, 3000))


def test_walk_ends_only_without_open_nodes(spark):
    n, angle = 24, np.linspace(np.pi, 0, 24)
    rows = [(i, np.array([np.cos(a), np.sin(a)], np.float16).tobytes()) for i, a in enumerate(angle)]
    nodes = spark.createDataFrame(rows, "node long, short binary")
    graph = spark.createDataFrame([(i, i + 1, 0.5, False) for i in range(n - 1)], "node long, nbr long, sim float, fresh boolean")
    queries = spark.createDataFrame([(7, rows[-1][1])], "query long, q binary")
    found = neighbours.walk(spark.createDataFrame([(7, 0)], "query long, node long"), queries, nodes, graph, beam=3)
    assert {r["node"] for r in found.collect()} == {n - 3, n - 2, n - 1}


def test_neighbours_of_odd_rows(spark):
    draw = np.random.default_rng(0)
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(1, 40)]
    rows += [(i, [1.0] * 8) for i in range(100, 160)]  # one very common vector
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0, None] + [0.0] * 6), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (205, []), (206, [1.0, 2.0]), (None, [1.0] * 8), (100, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, node int, ids int")
    got = neighbours.search(frame, F.col("vec_id") % 50 == 0).collect()
    answer = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got)
    assert answer == [(100, i + 1, 101 + i) for i in range(5)] + [(150, i + 1, 100 + i) for i in range(5)]
    assert all(r["score"] == pytest.approx(1.0) for r in got)
    assert neighbours.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.search(frame.where("vec_id = 150"), F.col("vec_id") % 50 == 0).count() == 0


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert len(names) == 5
    rated = {r["doc_id"] for r in quality.rate(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).where("kept").collect()}
    toxic = {r["doc_id"] for r in toxicity.classify(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).where("predicted = 1").collect()}
    good = stages[names[0]](spark, docs, SMALL).cache()
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == rated
    calm = stages[names[1]](spark, good, SMALL).cache()
    assert calm.columns == docs.columns and {r["doc_id"] for r in calm.collect()} == rated - toxic
    single = stages[names[2]](spark, calm, SMALL).cache()
    sets = {r["doc_id"]: near_dup._shingles(r["text"], 5) for r in calm.collect()}
    left = sorted(r["doc_id"] for r in single.collect())
    assert single.columns == docs.columns
    alike = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and len(sets[a] & sets[b]) > 0
    assert not any(alike(a, b) for i, a in enumerate(left) for b in left[:i])
    assert all(any(alike(k, other) for other in sets if other != k) for k in sets if k not in left)
    freed = stages[names[3]](spark, single, SMALL).cache()
    assert freed.columns == docs.columns
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    assert all(len(r["text"]) == r["n_chars"] <= len(before[r["doc_id"]]) for r in freed.collect())
    pieces = stages[names[4]](spark, freed, SMALL).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in freed.collect()}
    used = {}
    for p in pieces:
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert all(sum(n for _, n in s) == max(a + n for a, n in s) <= packing.MAX_TOKENS for s in used.values())


def test_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns, name
        got.collect()
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()
