"""Best-fit decreasing packing (operator 11).

A document is its ids under the word vocabulary and the end id; one of more
than ``size`` ids is cut into pieces of ``size`` (the last may be shorter).
Pieces are placed longest first, each in the open sequence with the least room
that still holds it, else in a new one.

Pieces of one length are interchangeable, and so are sequences with the same
room, so the whole corpus is placed from its histogram of lengths, at most
``size`` rows: ``OpenBins`` is a segment tree over remaining capacities that
finds the tightest one in logarithmic time, and a step fills a run of
sequences with a run of pieces where single pieces would go one after another
(as long as a sequence has room for another piece of the length at hand, it is
the tightest). The number of steps depends on ``size`` alone: a sequence that
is filled keeps less than half its room, so it is met at most log2(size) times,
and a length starts at most three new runs: below 70,000 steps for 2,048
(32 bytes each are broadcast), whatever the number of documents.

On Spark: partitions encode and cut their texts as they read them and number
the pieces of each length (texts and ids are never shuffled); counts by
partition and length give each partition its first number (a running sum per
length over partitions); a piece's number then finds its step by binary search.

Null text: the end id alone. Repeated rows are packed one by one, also under
one ``doc_id`` or none. Ties (pieces of one length) go by partition and row.
Empty table: no pieces. Other columns of the table are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, texts
from ledgerline.llm.word_tokens import WordTokens

SIZE, END = 2048, 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, number long"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "number"]


class OpenBins:
    """Runs of equal open bins by remaining capacity, under a segment tree
    that counts the runs below each node."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node //= 2

    def add(self, room: int, first: int, bins: int) -> None:
        """``bins`` consecutive bins from ``first`` on have ``room`` left."""
        if bins and room:
            self.runs[room].append((first, bins))
            self._count(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.runs[room].pop()

    def tightest(self, length: int) -> int | None:
        """The least capacity of ``length`` or more that a bin has left."""
        node = self.leaves + length
        if not self.tree[node]:
            while node > 1 and (node % 2 or not self.tree[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Steps ``(length, number, bin, per_bin, offset)``: pieces of a length
    from ``number`` on fill bins from ``bin`` on, ``per_bin`` in each, the
    first of them at ``offset``."""
    bins, used, steps = OpenBins(size), 0, []
    for length in sorted(histogram, reverse=True):
        number, left = 0, histogram[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room, first, many = size, used, -(-left // (size // length))
                used += many
            else:
                first, many = bins.take(room)
            per_bin = room // length
            full = min(many, left // per_bin)
            rest = left - full * per_bin if full < many else 0
            steps.append((length, number, first, per_bin, size - room))
            bins.add(room - per_bin * length, first, full)
            if rest:
                bins.add(room - rest * length, first + full, 1)
            taken = full + (rest > 0)
            bins.add(room, first + taken, many - taken)
            number += full * per_bin + rest
            left -= full * per_bin + rest
    return steps


def _cut(path: str | None, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokens.load(path)
        end_id = END.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        numbers: dict[int, int] = defaultdict(int)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)

        for read in batches:
            for doc_id, packed in zip(read.column("doc_id").to_pylist(), encoder.column(read.column("text"))):
                packed += end_id
                for piece, low in enumerate(range(0, len(packed), 4 * size)):
                    ids = packed[low : low + 4 * size]
                    length = len(ids) // 4
                    rows.append((doc_id, piece, low // 4, length, zlib.crc32(ids), ids if with_ids else None, part, numbers[length]))
                    numbers[length] += 1
                if len(rows) >= 2_000:
                    yield batch()
                    rows = []
        if rows:
            yield batch()

    return run


def _place(steps):
    """Rows with their number over all partitions -> rows in sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = steps.value
        # steps of one length follow each other, by number
        keys = table["length"] * -(1 << 48) + table["number"]
        for read in batches:
            length = read.column("length").to_numpy()
            number = read.column("number").to_numpy()
            step = np.searchsorted(keys, length * -(1 << 48) + number, side="right") - 1
            ahead, per_bin = number - table["number"][step], table["per_bin"][step]
            sequence = table["bin"][step] + ahead // per_bin
            offset = table["offset"][step] + ahead % per_bin * length
            out = read.drop_columns(["number"])
            yield out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(spark: SparkSession, docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset`` and, unless ``with_ids`` is
    off, the packed ``ids``."""
    scratch = Scratch(spark, "bestfit")
    pieces = scratch.keep(texts(docs).mapInArrow(_cut(tokenizer, size, with_ids), _PIECES), "pieces")
    counts = scratch.keep(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces")), "counts")
    # at most ``size`` rows, whatever the corpus
    histogram = {r["length"]: r["pieces"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    columns = zip(*best_fit_decreasing(histogram, size)) if histogram else [[]] * 5
    steps = spark.sparkContext.broadcast({n: np.array(c, dtype=np.int64) for n, c in zip(("length", "number", "bin", "per_bin", "offset"), columns)})
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    numbered = pieces.join(firsts, ["part", "length"]).select(*names, (F.col("first") + F.col("number")).alias("number"))
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", sequence_id long, offset long"
    return numbered.mapInArrow(_place(steps), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences of pieces that carry ids: ``sequence_id``, ``n_tokens``
    and the packed ``ids`` (a sequence is bounded by its size)."""
    parts = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return parts.select("sequence_id", "n_tokens", joined.alias("ids"))
