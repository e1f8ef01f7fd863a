"""Encoding, token files and packing against the library itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from touchline.llm import bpe, catalog, packing, token_files
from touchline.llm.tokens import read_definition

SF = "/root/testdata/sf0.001"
WORD, BYTE = catalog.tokenizer_file(catalog.WORD_BPE), catalog.tokenizer_file(catalog.BYTE_BPE)


def library(path):
    return Tokenizer.from_file(path)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("leaf", [7, 64, 100_000])
def test_encode_and_decode_equal_the_library(odd_docs, path, leaf):
    tokenizer = library(path)
    coded = bpe.decode(bpe.encode(odd_docs, path, leaf=leaf), path)
    assert set(coded.columns) == {*odd_docs.columns, "decoded"}
    rows = coded.collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        want = ids_of(tokenizer, row["text"])
        assert list(row["ids"]) == want
        assert row["decoded"] == tokenizer.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_fragments_of_unsplit_text_join_exactly(path):
    tokenizer, definition, draw = library(path), read_definition(path), random.Random(5)
    parts = ["a", "th", "the", "ing", "ABC", "é", "ß", "日本", "e\u0301", "0", "99", "!", "--", "'s", "'", "tion"]
    for _ in range(150):
        text = "".join(draw.choices(parts[: draw.choice([5, 9, len(parts)])], k=draw.randrange(1, 120)))
        leaves = list(bpe.leaves_of(text, definition, 6))
        coded = [(*leaf, ids) for leaf, ids in zip(leaves, bpe.encode_leaves(leaves, definition), strict=True)]
        assert bpe.join_leaves(coded, definition).tolist() == ids_of(tokenizer, text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_table_equals_the_library(path, monkeypatch):
    import pyarrow as pa

    from touchline.llm import tokens

    monkeypatch.setattr(tokens, "_DIRECT_BYTES", 0)
    tokenizer, draw = library(path), random.Random(9)
    encoder = tokens.WordEncoder(read_definition(path))
    parts = ["a", "The", " ", "\n", "  ", "\t", "x.", "é", "e\u0301", "\u00a0", "\x00", "<|endoftext|>", "ing ", "12 ", "'s", " ,"]
    for _ in range(40):
        texts = [None, "", *("".join(draw.choices(parts[: draw.choice([5, len(parts)])], k=draw.randrange(60))) for _ in range(30))]
        offsets, ids = encoder.encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert got == [ids_of(tokenizer, t) for t in texts]


def test_op1_equals_the_library(spark):
    tokenizer = library(WORD)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.QUERIES["op1_tree_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = ids_of(tokenizer, docs[row["doc_id"]])
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), digest)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def check_files(rows, docs):
    """``docs`` has (key, text) in key order; rows of one key may stand in any order."""
    tokenizer, start = library(BYTE), 0
    waiting = {}
    for key, text in docs:
        ids = [*ids_of(tokenizer, text), 2]
        waiting.setdefault(key, []).append((len(ids), crc(ids)))
    assert len(rows) == len(docs)
    for row, (key, _text) in zip(sorted(rows, key=lambda r: r["start"]), docs, strict=True):
        assert (row["doc_id"], row["start"]) == (key, start)
        waiting[key].remove((row["n_tokens"], row["ids_crc32"]))
        start += row["n_tokens"]


def test_op8_equals_the_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.QUERIES["op8_token_files"](spark, SF).collect()
    check_files(rows, sorted(docs.items()))


def test_token_files_of_odd_rows(odd_docs, tmp_path):
    rows = token_files.digests(odd_docs, str(tmp_path / "a"), BYTE, 2).collect()
    order = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    check_files(rows, order)
    assert [r["n_tokens"] for r in rows if r["doc_id"] == 0] == [1]


def test_single_documents_and_hash(spark, odd_docs, tmp_path):
    path = str(tmp_path / "b")
    token_files.write(odd_docs, path, BYTE, 2)
    assert [x.tolist() for x in token_files.read_one(spark, path, 9)] == [[*ids_of(library(BYTE), "don't I'll 12345"), 2]]
    assert len(token_files.read_one(spark, path, 4)) == 2
    assert token_files.read_one(spark, path, 99) == []
    spark.createDataFrame([("00", b"x")], "dictionary_hash string, dictionary binary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        token_files.read(spark, path)


def test_token_files_of_an_empty_table(spark, odd_docs, tmp_path):
    assert token_files.digests(odd_docs.limit(0), str(tmp_path / "c"), BYTE, 2).count() == 0
    assert bpe.digests(odd_docs.limit(0), WORD).count() == 0
    assert packing.pack_documents(odd_docs.limit(0), BYTE).count() == 0


def check_packing(rows, capacity):
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity.tokens
        assert len(spans) <= capacity.documents
        assert sum(n * n for _, n in spans) <= capacity.cost
    return len(sequences)


def test_op4_pieces_and_sequences(spark):
    tokenizer = library(BYTE)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.QUERIES["op4_best_fit_packing"](spark, SF).collect()
    used = check_packing(rows, packing.Capacity())
    assert used <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1
    got = {(r["doc_id"], r["piece"]): r for r in rows}
    for doc_id, text in docs.items():
        ids, piece, start = [*ids_of(tokenizer, text), 0], 0, 0
        while start < len(ids):
            size = (len(ids) - start - 1) % 2048 + 1
            row = got.pop((doc_id, piece))
            assert (row["start"], row["length"], row["ids_crc32"]) == (start, size, crc(ids[start : start + size]))
            start, piece = start + size, piece + 1
    assert not got


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_limit_holds_with_hot_lengths(spark, rule):
    capacity = packing.Capacity(tokens=100, documents=7, cost=4000, rule=rule)
    draw = random.Random(3)
    rows = [(i, 30 if i % 3 == 0 else draw.randint(1, 60)) for i in range(3000)] + [(1, 5), (1, 5)]
    items = spark.createDataFrame(rows, "doc_id long, length int")
    packed = packing.pack(items, "doc_id", capacity=capacity).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == sorted(rows)
    check_packing(packed, capacity)


def test_too_long_a_piece_is_an_error():
    with pytest.raises(ValueError, match="does not fit"):
        packing.plan([(2049, 1)])


def test_pieces_of_odd_rows(odd_docs):
    pieces = packing.token_pieces(odd_docs, BYTE, end_id=0, max_tokens=16, with_ids=True).collect()
    tokenizer = library(BYTE)
    for row in odd_docs.where("doc_id NOT IN (4)").collect():
        own = sorted((p["piece"], bytes(p["ids"])) for p in pieces if p["doc_id"] == row["doc_id"])
        assert np.frombuffer(b"".join(x for _, x in own), "<u4").tolist() == [*ids_of(tokenizer, row["text"]), 0]
        assert all(len(x) == 64 for _, x in own[1:])


@pytest.mark.parametrize("leaf", [7, 100_000])
def test_encode_with_decoded_texts_needs_no_second_pass(odd_docs, leaf):
    """The same rows as both operators one after the other, and no Python worker above the union of short and long texts."""
    both = bpe.encode(odd_docs, WORD, leaf=leaf, decoded="decoded")
    apart = bpe.decode(bpe.encode(odd_docs, WORD, leaf=leaf), WORD)
    columns = ["doc_id", "text", "ids", "decoded"]
    as_rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert both.columns == apart.columns and as_rows(both) == as_rows(apart)
    plan = bpe.digests(odd_docs, WORD)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan[: plan.index("Union")]


def test_runs_of_words_need_no_fragment_models(monkeypatch):
    monkeypatch.setattr(bpe, "_MODELS", {})
    definition, text = read_definition(WORD), "some words, and more of them " * 40
    leaves = list(bpe.leaves_of(text, definition, 64))
    coded = [(*leaf, ids) for leaf, ids in zip(leaves, bpe.encode_leaves(leaves, definition), strict=True)]
    assert bpe.join_leaves(coded, definition).tolist() == ids_of(library(WORD), text)
    assert len(leaves) > 1 and not bpe._MODELS


def test_decoding_goes_by_ids_and_not_by_rows(monkeypatch):
    import pyarrow as pa

    class Spy:
        calls = []

        def decode_batch(self, rows, skip_special_tokens):
            self.calls.append(sum(map(len, rows)))
            return tokenizer.decode_batch(rows, skip_special_tokens=skip_special_tokens)

    tokenizer, spy = library(WORD), Spy()
    monkeypatch.setattr(bpe, "encoder_for", lambda definition: type("E", (), {"tokenizer": spy}))
    rows = [ids_of(tokenizer, "long text of many words " * 4000), None, [], *[ids_of(tokenizer, f"word {i}") for i in range(300)]] * 5
    got = bpe._decoded(pa.array(rows, pa.list_(pa.int32())), "").to_pylist()
    assert got == [tokenizer.decode(x or [], skip_special_tokens=False) for x in rows]
    assert max(spy.calls) <= max(len(rows[0]), 1 << 16) and len(spy.calls) > 1


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_are_encoded_without_offsets(path, monkeypatch):
    import pyarrow as pa

    from touchline.llm import tokens

    class Fast:  # ``encode`` also works out offsets, which nobody reads
        encode_batch_fast = staticmethod(library(path).encode_batch_fast)

    monkeypatch.setattr(tokens, "_DIRECT_BYTES", 0)
    encoder, texts = tokens.WordEncoder(read_definition(path)), ["one two, three\nfour's", "five", None, "two 2 x."]
    encoder.tokenizer = Fast()
    offsets, ids = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [ids_of(library(path), t) for t in texts]


def test_a_stage_alone_gets_short_batches(spark):
    import corpus_pipeline
    import pyarrow as pa
    from touchline.llm.common import ARROW_ROWS

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    _name, stage = corpus_pipeline.stored("sizes", lambda _spark, docs, _dir: docs.mapInArrow(sizes, "n long"))
    rows = [r[0] for r in stage(spark, spark.range(0, 3500, 1, 1), SF).collect()]
    assert sum(rows) == 3500 and max(rows) <= ARROW_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_digests_shuffle_long_texts_twice_and_no_ids_after(odd_docs):
    plan = bpe.digests(odd_docs, WORD, leaf=7)._jdf.queryExecution().optimizedPlan().toString()
    after = plan[plan.index("Join") : plan.index("FlatMapGroupsInArrow")]
    assert "sha2" in after  # the join gets digests
    assert plan.count("RepartitionByExpression") == 1 and "first(text" not in plan
    rows = {str(r) for r in bpe.digests(odd_docs, WORD, leaf=7).collect()}
    assert rows == {str(r) for r in bpe.digests(odd_docs, WORD, leaf=1 << 20).collect()}
