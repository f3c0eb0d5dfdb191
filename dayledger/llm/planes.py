"""Token ids in files: fixed-size blocks, transposed into planes, each plane compressed.

A file set is a folder with two Parquet tables. `chunks` has a row for each chunk of whole
documents: part, chunk, the documents' ids and numbers of tokens, and a payload. `index`
tells for each chunk where its ids start in the whole sequence and which documents it has.

A payload is: magic, kind of planes (bits or bytes), number of ids and ids in a block, as
little-endian unsigned 32-bit integers, then block after block: the lengths of its planes
and the planes, each a zstandard frame, lowest plane first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.llm.shared import NO_ID, ship
from dayledger.llm.text_ids import space_split_ids

MAGIC = 0x31504C44
BITS, BYTES = 1, 8
#: Ids in a block.
BLOCK = 16384
#: A chunk ends with the document that brings it to so many ids.
CHUNK = 1 << 17
LEVEL = 3
CHUNKS = "part int, chunk int, doc_ids array<long>, doc_tokens array<long>, n_ids long, payload binary"


def _planes(ids: np.ndarray, kind: int) -> list[bytes]:
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == BYTES:
        return [np.ascontiguousarray(plane).tobytes() for plane in octets.T]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [plane.tobytes() for plane in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def _joined(planes: list[bytes], n: int, kind: int) -> np.ndarray:
    if kind == BYTES:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        octets = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


def encode_payload(ids: np.ndarray, kind: int = BYTES, block: int = BLOCK) -> bytes:
    import zstandard

    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    out = [np.array([MAGIC, kind, len(ids), block], "<u4").tobytes()]
    for start in range(0, len(ids), block):
        frames = [compress(plane) for plane in _planes(ids[start : start + block], kind)]
        out += [np.array([len(f) for f in frames], "<u4").tobytes(), *frames]
    return b"".join(out)


def decode_payload(payload: bytes) -> np.ndarray:
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    magic, kind, total, block = np.frombuffer(payload, "<u4", 4).tolist()
    if magic != MAGIC or kind not in (BITS, BYTES):
        raise ValueError("not a payload of token id planes")
    at, out, count = 16, [np.zeros(0, "<u4")], 32 // kind
    for start in range(0, total, block):
        lengths = np.frombuffer(payload, "<u4", count, at).tolist()
        at += 4 * count
        planes = []
        for length in lengths:
            planes.append(decompress(payload[at : at + length]))
            at += length
        out.append(_joined(planes, min(block, total - start), kind))
    return np.concatenate(out)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, kind: int = BYTES) -> None:
    """Encode every whole text, append end_id to each document, and write in ascending doc_id.

    Rows are range-partitioned by doc_id, and by text where ids repeat, so parts follow each
    other; rows without doc_id come first. A null text is empty: end_id alone. A part is numbered
    by its place in that order, so a task that runs again writes the same.
    """
    ship(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = space_split_ids(tokenizer).encode, TaskContext.get().partitionId(), 0
        held, sizes, ids, total = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            payload = encode_payload(np.frombuffer(b"".join(ids), "<u4"), kind)
            longs = pa.list_(pa.int64())
            columns = [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], longs),
                pa.array([sizes], longs), pa.array([total], pa.int64()), pa.array([payload], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CHUNKS.split(", ")])

        for batch in batches:
            encoded = encode(batch.column("text").to_pylist())
            for doc_id, plain in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                own = plain + end
                held.append(doc_id)
                sizes.append(len(own) // 4)
                ids.append(own)
                total += sizes[-1]
                if total >= CHUNK:
                    yield chunk()
                    held, sizes, ids, total, number = [], [], [], 0, number + 1
        if held:
            yield chunk()

    keyed = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("version"), "doc_id", "text"
    )
    ordered = keyed.repartitionByRange("id", "version").sortWithinPartitions("id", "version")
    chunks = ordered.select("doc_id", "text").mapInArrow(rows, CHUNKS)
    chunks.write.option("compression", "none").parquet(f"{path}/chunks")

    written = docs.sparkSession.read.schema(CHUNKS).parquet(f"{path}/chunks").drop("payload")
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row for each part, so a few thousand at most; the window inside a part is its chunks.
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    written.withColumn("own", own).join(starts, "part").select(
        "part",
        "chunk",
        (F.col("part_start") + F.col("own")).alias("start"),
        "n_ids",
        F.get("doc_ids", F.lit(0)).alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"),
    ).write.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files.

    ids_crc32 is over the document's ids as little-endian unsigned 32-bit integers. A chunk
    holds whole documents, so chunks are decoded where they are read.
    """
    ship(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, chunk, docs, sizes, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, at = decode_payload(payload).tobytes(), 0
                for doc_id, size in zip(docs, sizes, strict=True):
                    out.append((part, chunk, doc_id, at, size, zlib.crc32(data[4 * at : 4 * (at + size)])))
                    at += size
            columns = zip(*out, strict=True) if out else [[]] * 6
            names = ["part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"]
            types = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    found = chunks.select("part", "chunk", "doc_ids", "doc_tokens", "payload").mapInArrow(
        rows, "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    index = spark.read.parquet(f"{path}/index").select("part", "chunk", F.col("start").alias("chunk_start"))
    return found.join(index, ["part", "chunk"]).select(
        "doc_id", (F.col("chunk_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
