"""Token ids in files: blocks of compressed documents with an index, readable document by document.

Format, below one folder: ``dictionary`` holds one row (hash, bytes) of a
zstandard dictionary trained on serialized id arrays. ``blocks`` holds rows in
ascending key order; each has a payload of frames, one per document, and the
index of its documents: key, offset and length of the frame, number of ids.
Every block names the hash of its dictionary. A frame decompresses to ids as
little-endian unsigned 32-bit integers, and opening one touches no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import shuffle_width
from touchline.llm.tokens import encoder_for, read_definition

SAMPLE_DOCS = 512
SAMPLE_CHARS = 16_384
DICTIONARY_BYTES = 65_536
BLOCK_DOCS = 256
BLOCK_BYTES = 1 << 20
LEVEL = 3


def train_dictionary(
    docs: DataFrame, definition: str, key: str, text: str, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS
) -> bytes:
    """Dictionary from a bounded sample: ``sample_docs`` texts by a hash of the key, ``sample_chars`` of each at most.

    Only the fit is bounded; every document is then coded whole. Without
    enough text for a dictionary it is empty and frames stand alone.
    """
    import zstandard

    body = F.substring(F.coalesce(F.col(text), F.lit("")), 1, sample_chars)
    share = min(1.0, 4 * sample_docs / max(1, docs.count()))
    chosen = docs.select(F.xxhash64(key).alias("__llm_rank"), body.alias("__llm_body"))
    # The hash leaves about four times the sample, so what the tasks send to the driver does not grow with the table.
    chosen = chosen.where(F.col("__llm_rank") <= min(2**63 - 1, int((share - 0.5) * 2**64)))
    rows = chosen.orderBy("__llm_rank", "__llm_body").limit(sample_docs).collect()
    if not rows:
        return b""
    offsets, ids = encoder_for(definition).encode(pa.array([r[1] for r in rows]))
    samples = [ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b > a]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b""


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode ``text`` and write it below ``path`` in ascending ``key`` order.

    A null text counts as empty; with ``end_id`` every document then still has
    that one id. Rows may repeat: equal keys stand side by side, ordered by
    a hash of their texts. Null keys come first. An empty table writes no blocks.
    """
    spark = docs.sparkSession
    definition = read_definition(tokenizer_path)
    dictionary = train_dictionary(docs, definition, key, text)
    name = dictionary_hash(dictionary)
    shared, model = spark.sparkContext.broadcast(dictionary), spark.sparkContext.broadcast(definition)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        trained = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_dict_id=False)
        last = np.array([] if end_id is None else [end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            offsets, ids = encoder_for(model.value).encode(batch.column(1))
            flat, sizes, at = ids.astype("<u4", copy=False), np.diff(offsets) + len(last) // 4, 0
            held, size = [], 0
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                held.append(frames.compress(flat[a:b].tobytes() + last))
                size += len(held[-1])
                if len(held) == BLOCK_DOCS or size >= BLOCK_BYTES or row + 1 == len(sizes):
                    own = sizes[at : row + 1]
                    yield _block(part, before, batch.column(0).slice(at, len(own)), own, held, name)
                    before, at, held, size = before + int(own.sum()), row + 1, [], 0

    kind = docs.schema[key].dataType.simpleString()
    # Texts are dealt out before they are encoded: finding the ranges reads them once more, but encodes nothing twice.
    # The ranges' bounds go through the driver, so texts themselves are no part of the order.
    order = [F.col(key), F.xxhash64(text)]
    ordered = docs.select(key, text).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    index = f"array<struct<key:{kind},offset:bigint,length:bigint,n_ids:bigint>>"
    schema = f"part int, ids_before long, n_ids long, dictionary_hash string, index {index}, payload binary"
    ordered.mapInArrow(blocks, schema).write.parquet(f"{path}/blocks")
    spark.createDataFrame([(name, dictionary)], "dictionary_hash string, dictionary binary").write.parquet(
        f"{path}/dictionary"
    )


def _block(part: int, before: int, keys: pa.Array, sizes: np.ndarray, frames: list[bytes], name: str) -> pa.RecordBatch:
    lengths = np.array([len(f) for f in frames], np.int64)
    entries = pa.StructArray.from_arrays(
        [keys, pa.array(np.cumsum(lengths) - lengths), pa.array(lengths), pa.array(sizes, pa.int64())],
        ["key", "offset", "length", "n_ids"],
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([before], pa.int64()),
            pa.array([int(sizes.sum())], pa.int64()),
            pa.array([name]),
            pa.ListArray.from_arrays(pa.array([0, len(frames)], pa.int32()), entries),
            pa.array([b"".join(frames)], pa.binary()),
        ],
        ["part", "ids_before", "n_ids", "dictionary_hash", "index", "payload"],
    )


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Every document of the files: its key, ``start`` (ids before it), ``n_tokens`` and ``tokens``, the ids as bytes.

    A dictionary that does not match the hash in a block stops the read.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    row = spark.read.parquet(f"{path}/dictionary").first()
    if dictionary_hash(bytes(row["dictionary"])) != row["dictionary_hash"]:
        raise ValueError("the stored dictionary does not match its hash")
    dictionary = spark.sparkContext.broadcast(bytes(row["dictionary"]))
    name = row["dictionary_hash"]
    # One row per written partition, so the list is as long as the shuffle is wide.
    parts = sorted((r[0], r[1]) for r in blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    starts = dict(zip([p for p, _ in parts], np.cumsum([0, *[n for _, n in parts]])[:-1].tolist(), strict=True))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        trained = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        frames = zstandard.ZstdDecompressor(dict_data=trained)
        for batch in batches:
            for part, before, hashed, index, payload in zip(*(c for c in batch.columns), strict=True):
                if hashed.as_py() != name:
                    raise ValueError("a block was written with another dictionary")
                entries, buffer = index.values, payload.as_buffer()
                sizes = entries.field("n_ids").to_numpy()
                spans = zip(entries.field("offset").to_pylist(), entries.field("length").to_pylist(), strict=True)
                whole = memoryview(buffer)
                ids = [frames.decompress(whole[a : a + n]) for a, n in spans]
                first = starts[part.as_py()] + before.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        entries.field("key"),
                        pa.array(first + np.cumsum(sizes) - sizes, pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    [key, "start", "n_tokens", "tokens"],
                )

    kind = blocks.schema["index"].dataType.elementType["key"].dataType.simpleString()
    columns = blocks.select("part", "ids_before", "dictionary_hash", "index", "payload")
    return columns.mapInArrow(documents, f"`{key}` {kind}, start long, n_tokens long, tokens binary")


def read_one(spark: SparkSession, path: str, wanted: int) -> list[np.ndarray]:
    """The ids of the documents with one key: only blocks whose index names it are opened."""
    import zstandard

    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    blocks = spark.read.parquet(f"{path}/blocks").where(F.array_contains(F.col("index.key"), F.lit(wanted)))
    entry = blocks.select(F.explode("index").alias("e"), "payload").where(F.col("e.key") == wanted)
    frame = F.expr("substring(payload, cast(e.offset AS int) + 1, cast(e.length AS int))")
    return [np.frombuffer(frames.decompress(bytes(r[0])), "<u4") for r in entry.select(frame).collect()]


def digests(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` below ``path``, read the files back, and give start, count and CRC-32 per document."""
    write(docs, path, tokenizer_path, end_id, key, text)
    stored = read(docs.sparkSession, path, key)
    return stored.select(key, "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
