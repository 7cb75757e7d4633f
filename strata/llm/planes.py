"""Token ids in files of bit-shuffled, compressed blocks with a chunk index.

A file is a Parquet file of segments; a segment holds whole documents in ascending order of
their keys. Its ids are cut into blocks of ``BLOCK`` ids; the bytes of a block are transposed
into four planes (all lowest bytes first, and so on; the upper ones are nearly constant), and
each plane is compressed with zstandard. The chunk index of a segment has one entry per block:
number of ids, place and length of its planes, checksum. So one document is read from the
blocks it touches alone. Spark's writer commits the files, on any store it can write to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import picked
from strata.llm.encoding import encoder, id_bytes

BLOCK = 1 << 15
SEGMENT_IDS = 1 << 20
LEVEL = 3
_PLANES = 4  # Bytes of an id.
_INDEX = "array<struct<ids: int, crc32: bigint, at: array<int>, bytes: array<int>>>"


def pack_block(ids: np.ndarray, level: int = LEVEL) -> list[bytes]:
    """The compressed byte planes of a block of ids."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, _PLANES).T)
    return [zstandard.ZstdCompressor(level=level).compress(plane.tobytes()) for plane in planes]


def unpack_block(planes: list[bytes], count: int) -> np.ndarray:
    raw = [zstandard.ZstdDecompressor().decompress(p, max_output_size=count) for p in planes]
    bytes_of = np.stack([np.frombuffer(r, dtype=np.uint8) for r in raw], axis=1)
    return np.ascontiguousarray(bytes_of).view("<u4").ravel()


class _Segment:
    """Documents of one segment while it is filled."""

    def __init__(self, shard: int, number: int, start: int):
        self.shard, self.number, self.start = shard, number, start
        self.keys, self.lengths, self.data = [], [], []

    def add(self, key, data: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(data) // 4)
        self.data.append(data)

    def row(self) -> dict:
        ids = np.frombuffer(b"".join(self.data), dtype="<u4")
        index, payload, at = [], [], 0
        for first in range(0, len(ids), BLOCK):
            block = ids[first : first + BLOCK]
            planes = pack_block(block)
            places = [at + sum(map(len, planes[:k])) for k in range(_PLANES)]
            index.append(
                {
                    "ids": len(block),
                    "crc32": zlib.crc32(block.tobytes()),
                    "at": places,
                    "bytes": list(map(len, planes)),
                }
            )
            payload.extend(planes)
            at += sum(map(len, planes))
        return {
            "shard": self.shard,
            "segment": self.number,
            "shard_start": self.start,
            "n_ids": len(ids),
            "keys": self.keys,
            "lengths": self.lengths,
            "chunk_index": index,
            "planes": b"".join(payload),
        }


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of all texts below ``path`` in ascending order of ``key``.

    A NULL text is empty; with ``end_id`` every document ends with it. NULL keys come first;
    rows that repeat a key are ordered by a hash of their text. A document longer than
    ``segment_ids`` is a segment of its own. An empty table gives files without segments.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"shard int, segment int, shard_start bigint, n_ids int, keys array<{kind}>, "
        f"lengths array<int>, chunk_index {_INDEX}, planes binary"
    )
    end = b"" if end_id is None else id_bytes([end_id])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer), TaskContext.get().partitionId()
        segment, held = _Segment(shard, 0, 0), 0
        types = None
        for batch in batches:
            types = _arrow_schema(batch.schema.field("_key").type)
            keys = batch.column("_key").to_pylist()
            for own, data in zip(keys, encode(batch.column("_text").to_pylist())):
                segment.add(own, data + end)
                held += segment.lengths[-1]
                if held >= segment_ids:
                    yield pa.RecordBatch.from_pylist([segment.row()], schema=types)
                    segment = _Segment(shard, segment.number + 1, segment.start + held)
                    held = 0
        if segment.keys:
            yield pa.RecordBatch.from_pylist([segment.row()], schema=types)

    rows = picked(docs, _key=key, _text=text).withColumn("_tie", F.xxhash64("_text"))
    ordered = rows.repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie")
    ordered.select("_key", "_text").mapInArrow(segments, schema).write.option(
        "compression", "uncompressed"
    ).parquet(path)


def _arrow_schema(key: pa.DataType) -> pa.Schema:
    entry = pa.struct(
        [("ids", pa.int32()), ("crc32", pa.int64()), ("at", pa.list_(pa.int32())), ("bytes", pa.list_(pa.int32()))]
    )
    return pa.schema(
        [
            ("shard", pa.int32()),
            ("segment", pa.int32()),
            ("shard_start", pa.int64()),
            ("n_ids", pa.int32()),
            ("keys", pa.list_(key)),
            ("lengths", pa.list_(pa.int32())),
            ("chunk_index", pa.list_(entry)),
            ("planes", pa.binary()),
        ]
    )


def decode(index: list[dict], planes: bytes, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a segment, out of the blocks that hold them."""
    found, before = [np.zeros(0, dtype="<u4")], 0
    for entry in index:
        after = before + entry["ids"]
        if before < first + count and first < after:
            parts = [planes[a : a + n] for a, n in zip(entry["at"], entry["bytes"])]
            block = unpack_block(parts, entry["ids"])
            if zlib.crc32(block.tobytes()) != entry["crc32"]:
                raise ValueError("a block of ids does not match its checksum")
            found.append(block[max(0, first - before) : first + count - before])
        before = after
    return np.concatenate(found)


def _starts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The segments and, with a row per file, the ids in all files before."""
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).cast("long")
    return stored, sizes.select("shard", before.alias("_before"))


def read_ids(spark: SparkSession, path: str, keys: Sequence | None = None) -> DataFrame:
    """What is stored below ``path``: key, start (ids of all documents before), n_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit numbers. With ``keys`` only those documents are
    returned, and only the blocks that hold them are decompressed.
    """
    stored, before = _starts(spark, path)
    kind = stored.schema["keys"].dataType.elementType.simpleString()
    wanted = None if keys is None else set(keys)
    if wanted is not None:
        stored = stored.filter(F.arrays_overlap("keys", F.array(*map(F.lit, wanted))))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment in batch.to_pylist():
                yield _documents(segment, batch.schema.field("keys").type.value_type, wanted)

    schema = f"key {kind}, shard int, in_shard bigint, n_tokens bigint, ids binary"
    found = stored.select("keys", "lengths", "chunk_index", "planes", "shard", "shard_start")
    found = found.mapInArrow(documents, schema)
    placed = found.join(F.broadcast(before), "shard")
    start = (F.col("_before") + F.col("in_shard")).alias("start")
    return placed.select("key", start, "n_tokens", "ids")


def _documents(segment: dict, kind: pa.DataType, wanted: set | None) -> pa.RecordBatch:
    ends = np.cumsum(segment["lengths"])
    spans = list(zip(segment["keys"], (ends - np.array(segment["lengths"])).tolist(), ends.tolist()))
    index, planes = segment["chunk_index"], segment["planes"]
    if wanted is None:
        data = decode(index, planes, 0, int(ends[-1])).tobytes()
        parts = [data[4 * a : 4 * b] for _, a, b in spans]
    else:
        spans = [span for span in spans if span[0] in wanted]
        parts = [decode(index, planes, a, b - a).tobytes() for _, a, b in spans]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key for key, _, _ in spans], kind),
            pa.array([segment["shard"]] * len(spans), pa.int32()),
            pa.array([a + segment["shard_start"] for _, a, _ in spans], pa.int64()),
            pa.array([b - a for _, a, b in spans], pa.int64()),
            pa.array(parts, pa.binary()),
        ],
        names=["key", "shard", "in_shard", "n_tokens", "ids"],
    )
