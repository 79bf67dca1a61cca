"""Token ids in binary chunks of bit or byte planes.

A store is a folder with two Parquet tables. ``chunks`` has one row per chunk: whole documents in
ascending id order, their ids in one run, cut into blocks of ``BLOCK`` ids. Each block is transposed
into planes (all first bytes, all second bytes, ...; or all lowest bits, ...) and each plane is
compressed with zstandard by itself, so planes that never change cost nothing. The payload starts with
the sizes of all planes, so one block can be read alone. ``index`` is the chunk index without payloads.

Payload, little-endian: ``PLN1``, planes per block, ids per block, ids, blocks (4 unsigned 32-bit
numbers), then the sizes of the compressed planes (unsigned 32-bit, 0: all zero), then the planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.common import shuffle_width, small_batches, text_of
from stayline.llm.tokens import encoder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1 << 16
#: A chunk ends with the document that brings it to this many ids.
CHUNK = 1 << 19
LEVEL = 3
MAGIC = b"PLN1"
PLANES = {"byte": 4, "bit": 32}


def to_planes(block: np.ndarray, kind: str) -> np.ndarray:
    """Planes of a block of unsigned 32-bit ids, one per row; bit planes are padded to whole bytes."""
    octets = block.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return np.ascontiguousarray(octets.T)
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int) -> np.ndarray:
    if len(planes) == PLANES["byte"]:
        return np.ascontiguousarray(planes.T).view("<u4").ravel()
    bits = np.unpackbits(planes, axis=1, bitorder="little")[:, :n]
    return np.packbits(bits.T, axis=1, bitorder="little").copy().view("<u4").ravel()


def pack_ids(ids: np.ndarray, kind: str = "byte", block: int = BLOCK) -> bytes:
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    sizes, bodies = [], []
    for at in range(0, len(ids), block):
        for plane in to_planes(ids[at : at + block], kind):
            body = squeeze(plane.tobytes()) if plane.any() else b""
            sizes.append(len(body))
            bodies.append(body)
    head = struct.pack("<4s4I", MAGIC, PLANES[kind], block, len(ids), -(-len(ids) // block))
    return head + np.array(sizes, "<u4").tobytes() + b"".join(bodies)


def unpack_ids(payload: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + count``; only the blocks they lie in are decompressed."""
    magic, planes, block, total, blocks = struct.unpack_from("<4s4I", payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of token planes")
    start = struct.calcsize("<4s4I")
    sizes = np.frombuffer(payload, "<u4", planes * blocks, start).astype(np.int64)
    places = start + 4 * len(sizes) + np.concatenate([[0], np.cumsum(sizes)])
    last = total if count is None else min(total, first + count)
    expand = zstandard.ZstdDecompressor().decompress
    found = [np.empty(0, "<u4")]
    for b in range(first // block, -(-last // block) if last > first else 0):
        n = min(block, total - b * block)
        width = n if planes == PLANES["byte"] else -(-n // 8)
        table = np.zeros((planes, width), np.uint8)
        for p in range(planes):
            if size := sizes[b * planes + p]:
                at = places[b * planes + p]
                table[p] = np.frombuffer(expand(payload[at : at + size], max_output_size=width), np.uint8)
        ids = from_planes(table, n)
        found.append(ids[max(0, first - b * block) : last - b * block])
    return np.concatenate(found)


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
          end_id: int = END_ID, kind: str = "byte", block: int = BLOCK, chunk: int = CHUNK,
          shards: int | None = None) -> None:
    """Encode whole texts, each followed by ``end_id``, and write the store below ``path``.

    Documents are dealt to shards by ranges of their id, so shards and the chunks in them follow the
    order of ids; repeated ids follow by text. Null ids come first, a null text counts as empty.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard = encoder(vocabulary, False), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        names: list[pa.Array] = []
        size = first = number = 0

        def flush() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in held]
            owners = pa.concat_arrays(names)
            row = {
                "shard": pa.array([shard], "int32"), "chunk": pa.array([number], "int32"),
                "first": pa.array([first], "int64"), "n_ids": pa.array([size], "int64"),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(owners)], "int32"), owners),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "payload": pa.array([pack_ids(np.frombuffer(b"".join(held), "<u4"), kind, block)], "binary"),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for batch in batches:
            encoded = tokens.encode(batch.column(1).to_pylist())
            begun = 0
            for i, ids in enumerate(encoded):
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= chunk:
                    names.append(batch.column(0).slice(begun, i + 1 - begun))
                    yield flush()
                    begun, first, number, size = i + 1, first + size, number + 1, 0
                    held.clear()
                    names.clear()
            if begun < batch.num_rows:
                names.append(batch.column(0).slice(begun))
        if held:
            yield flush()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text).alias("text"))
    id_type = dict(rows.dtypes)["id"]
    ordered = rows.repartitionByRange(shards or shuffle_width(docs), "id").sortWithinPartitions("id", "text")
    schema = (f"shard int, chunk int, first bigint, n_ids bigint, doc_ids array<{id_type}>, lengths array<bigint>, "
              "payload binary")
    with small_batches(spark):
        ordered.mapInArrow(encode, schema).write.parquet(f"{path}/chunks")
    made = spark.read.parquet(f"{path}/chunks")
    index = made.select("shard", "chunk", "first", "n_ids", F.size("doc_ids").alias("n_docs"),
                        F.get("doc_ids", F.lit(0)).alias("first_doc"), F.octet_length("payload").alias("n_bytes"))
    # One number per shard is summed up; a shard's ids start after those of all shards before it.
    shard_sums = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shard_sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    index.join(F.broadcast(starts), "shard").withColumn("start", F.col("base") + F.col("first")).drop(
        "base", "first").write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (shard, chunk, start, n_ids, n_docs, first_doc, n_bytes); ``start`` counts from the first id of all."""
    return spark.read.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Per document from the chunks: ``id_col, start, n_tokens, ids_crc32`` and the ids, as a binary column."""
    chunks = spark.read.parquet(f"{path}/chunks")
    id_type = chunks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = unpack_ids(batch.column("payload")[r].as_py()).tobytes()
                lengths = np.array(batch.column("lengths")[r].as_py(), np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[4 * a : 4 * b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                n = len(parts)
                row = {
                    id_col: batch.column("doc_ids")[r].values,
                    "_shard": pa.array([batch.column("shard")[r].as_py()] * n, "int32"),
                    "_chunk": pa.array([batch.column("chunk")[r].as_py()] * n, "int32"),
                    "_at": pa.array(ends - lengths, "int64"), "n_tokens": pa.array(lengths, "int64"),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in parts], "int64"),
                }
                if with_ids:
                    row["ids"] = pa.array(parts, "binary")
                yield pa.RecordBatch.from_arrays(list(row.values()), list(row))

    schema = f"`{id_col}` {id_type}, _shard int, _chunk int, _at bigint, n_tokens bigint, ids_crc32 bigint"
    docs = chunks.mapInArrow(decode, schema + ", ids binary" * with_ids)
    starts = read_index(spark, path).select(
        F.col("shard").alias("_shard"), F.col("chunk").alias("_chunk"), F.col("start").alias("_start"))
    return docs.join(starts, ["_shard", "_chunk"]).select(
        F.col(f"`{id_col}`"), (F.col("_start") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))
