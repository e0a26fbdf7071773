"""Token files in patched frame-of-reference blocks (operator 10).

Documents are range-partitioned and sorted by ``doc_id``; each partition (a
shard) encodes its texts as it reads them and writes segments of whole
documents, about ``SEGMENT`` ids each. Spark's own writer commits them, so the
files can lie in any store and a lost executor only repeats its shard. A row
of the files is one segment: ``shard``, ``segment``, ``shard_start`` (ids of
the shard before it), ``n_ids`` and ``payload``, which is, little-endian:

    "PFOR", u32 documents, u32 blocks, u32 ids
    i64 doc_id x documents (null ids are marked in the next field's top bit)
    u32 ids of each document
    u32 byte offset of each block, counted from the first block
    blocks of BLOCK ids (the last one filled up with its last id):
        u32 minimum, u8 width, u8 0, u16 exceptions
        width planes of BLOCK bits: the bits of id - minimum, lowest first
        u16 position x exceptions, u32 id - minimum x exceptions

The width is that of the ``PERCENTILE`` of a block's differences; larger ones
are exceptions. The block index gives any id range without decoding the rest.

Null text: the end id alone. Rows that repeat a doc_id are stored one by one,
ordered by a hash of the text, by which they are also dealt to shards: many rows
under one id, or under none, are no single shard. Null doc_ids come first. Empty
table: no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import texts
from ledgerline.llm.byte_tokens import ByteTokens

BLOCK, PERCENTILE, SEGMENT, END = 512, 0.95, 1 << 18, 2
SPAN = 8 << 20  # bytes of rows encoded together: the more, the fewer pieces are looked up again
MAGIC, NULL_BIT = b"PFOR", 1 << 31
SCHEMA = "shard int, segment int, shard_start long, n_ids long, payload binary"


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The blocks of an id array and where each starts."""
    count = -(-ids.size // BLOCK)
    if not count:
        return [], np.zeros(0, dtype=np.uint32)
    padded = np.concatenate([ids, np.full(count * BLOCK - ids.size, ids[-1], dtype=np.uint32)]).reshape(count, BLOCK)
    least = padded.min(axis=1)
    rest = padded - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    typical = np.partition(rest, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    limit = ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    packed: list[bytes] = [b""] * count
    for bits in np.unique(width[width > 0]):
        own = np.flatnonzero(width == bits)
        low = rest[own] if bits > 16 else rest[own].astype(np.uint16)
        planes = [np.packbits(((low >> low.dtype.type(k)) & low.dtype.type(1)).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)]
        for k, row in zip(own, np.concatenate(planes, axis=1)):
            packed[k] = row.tobytes()
    over = rest > limit[:, None]
    many = over.sum(axis=1)
    blocks = []
    for k in range(count):
        block = struct.pack("<IBBH", int(least[k]), int(width[k]), 0, int(many[k])) + packed[k]
        if many[k]:
            at = np.flatnonzero(over[k])
            block += at.astype("<u2").tobytes() + rest[k][at].astype("<u4").tobytes()
        blocks.append(block)
    sizes = np.array([len(b) for b in blocks], dtype=np.uint64)
    return blocks, (np.cumsum(sizes) - sizes).astype(np.uint32)


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at ``starts``, in order."""
    raw = np.frombuffer(data, dtype=np.uint8)
    heads = np.frombuffer(raw[starts[:, None] + np.arange(8)].tobytes(), dtype=[("least", "<u4"), ("width", "u1"), ("zero", "u1"), ("over", "<u2")])
    out = np.zeros((starts.size, BLOCK), dtype=np.uint32)
    for bits in np.unique(heads["width"][heads["width"] > 0]):
        own = np.flatnonzero(heads["width"] == bits)
        packed = raw[starts[own][:, None] + 8 + np.arange(int(bits) * BLOCK // 8)]
        low = np.zeros((own.size, BLOCK), dtype=np.uint16 if bits <= 16 else np.uint32)
        for k in range(bits):
            plane = np.unpackbits(packed[:, k * BLOCK // 8 : (k + 1) * BLOCK // 8], axis=1, bitorder="little")
            low |= plane.astype(low.dtype) << low.dtype.type(k)
        out[own] = low
    for k in np.flatnonzero(heads["over"]):
        at, many = int(starts[k]) + 8 + int(heads["width"][k]) * BLOCK // 8, int(heads["over"][k])
        out[k, np.frombuffer(data, "<u2", many, at)] = np.frombuffer(data, "<u4", many, at + 2 * many)
    return (out + heads["least"][:, None]).reshape(-1)


def encode_segment(doc_ids: list[int | None], packed: list[bytes]) -> tuple[bytes, int]:
    ids = np.frombuffer(b"".join(packed), dtype="<u4")
    counts = np.array([len(p) // 4 + (NULL_BIT if d is None else 0) for d, p in zip(doc_ids, packed)], dtype="<u4")
    blocks, starts = encode_blocks(ids)
    head = MAGIC + struct.pack("<III", len(doc_ids), len(blocks), ids.size)
    keys = np.array([d or 0 for d in doc_ids], dtype="<i8")
    return b"".join([head, keys.tobytes(), counts.tobytes(), starts.astype("<u4").tobytes(), *blocks]), ids.size


def _layout(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int, int]:
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    docs, blocks, ids = struct.unpack_from("<III", payload, 4)
    at = 16
    keys = np.frombuffer(payload, "<i8", docs, at)
    counts = np.frombuffer(payload, "<u4", docs, at + 8 * docs)
    starts = np.frombuffer(payload, "<u4", blocks, at + 12 * docs)
    null = (counts & NULL_BIT) > 0
    return [None if n else int(k) for k, n in zip(keys, null)], counts & (NULL_BIT - 1), starts, at + 12 * docs + 4 * blocks, ids


def read_ids(payload: bytes, low: int, high: int) -> np.ndarray:
    """Ids ``low`` to ``high`` (exclusive) of a segment; only their blocks are
    decoded."""
    _, _, starts, base, ids = _layout(payload)
    high = min(high, ids)
    if low >= high:
        return np.zeros(0, dtype=np.uint32)
    first = low // BLOCK
    joined = decode_blocks(payload, base + starts[first : -(-high // BLOCK)].astype(np.int64))
    return joined[low - first * BLOCK : high - first * BLOCK]


def decode_segment(payload: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start in the segment, ids)`` of each document."""
    keys, counts, _, _, ids = _layout(payload)
    every = read_ids(payload, 0, ids)
    ends = np.cumsum(counts.astype(np.int64))
    for key, end, count in zip(keys, ends, counts):
        yield key, int(end - count), every[end - count : end]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a stream in batches of up to ``SPAN`` bytes, or single ones as
    they come."""
    held: list[pa.RecordBatch] = []
    size = 0
    for rows in batches:
        if held and size + rows.nbytes > SPAN:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(rows)
        size += rows.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _write(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.load(path)
        end_id = END.to_bytes(4, "little")
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            payload, count = encode_segment(keys, held)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()), pa.array([count], pa.int64()), pa.array([payload], pa.binary())],
                names=["shard", "segment", "shard_start", "n_ids", "payload"],
            )

        for rows in _joined(batches):
            for doc_id, packed in zip(rows.column("doc_id").to_pylist(), encoder.column(rows.column("text"), SPAN)):
                keys.append(doc_id)
                held.append(packed + end_id)
                size += len(packed) // 4 + 1
                if size >= SEGMENT:
                    yield flush()
                    segment, before, keys, held, size = segment + 1, before + size, [], [], 0
        if keys:
            yield flush()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the ids of all documents in ascending ``doc_id`` order."""
    order = ["doc_id", F.xxhash64("text")]
    ordered = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ordered.mapInArrow(_write(tokenizer), SCHEMA).write.mode("overwrite").option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for shard, before, payload in zip(*(rows.column(c).to_pylist() for c in ("shard", "shard_start", "payload"))):
            found = [(doc_id, shard, before + start, ids.size, zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, start, ids in decode_segment(payload)]
            columns = zip(*found)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["doc_id", "shard", "in_shard", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every stored document; a
    shard's start is the sum of the shards before it (a row per shard)."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    found = stored.select("shard", "shard_start", "payload").mapInArrow(_read, "doc_id long, shard int, in_shard long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")
