"""Bounded-space online packing (operator 4).

Every scan partition packs its documents as it reads them and never shuffles a
text or a token. A document's ids (with the end id) are cut into full windows
of ``size`` and a remainder. A fixed number of windows (``open_windows``) stays
open: a remainder goes to the open window it fits best; when it fits none and
all are in use, the fullest one is emitted. If that window would leave
``min_cut`` places or more unused it is first filled with the head of the
remainder, and the rest is placed again.

What is open when a partition ends are the leftovers, at most ``open_windows``
per partition. They are dealt to groups of about ``MERGE`` windows and merged
best-fit, fullest first; each group is one small task over window sizes only,
and only the pieces of leftovers are joined to where they moved.

Results are the same whenever a partition is computed again: window numbers
come from the partition and the order of its rows. Null text: the end id
alone. Repeated rows are packed one by one. Empty table: no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_tokens import ByteTokens
from ledgerline.llm.common import Scratch, texts

SIZE, OPEN_WINDOWS, MIN_CUT, MERGE, END = 2048, 32, 64, 4096, 1
# Runs whose ids a worker keeps: it may have the memory of a pipeline's earlier stages too.
KEPT = 250_000
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "fill", "ids"]
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, fill int, ids binary"


class Window:
    def __init__(self, number: int):
        self.number, self.used, self.pieces = number, 0, []

    def add(self, piece: tuple, length: int) -> None:
        self.pieces.append((*piece, self.number, self.used))
        self.used += length


class Packer:
    """One partition's open windows; ``done`` holds pieces ready to go out."""

    def __init__(self, first: int, size: int, keep: int, min_cut: int):
        self.size, self.keep, self.min_cut = size, keep, min_cut
        self.next, self.open, self.done = first, [], []

    def _window(self) -> Window:
        self.next += 1
        return Window(self.next - 1)

    def _emit(self, window: Window) -> None:
        self.done += [(*p, None) for p in window.pieces]

    def place(self, piece, start: int, end: int) -> None:
        """``piece(start, end)`` makes the row of those ids."""
        while start < end:
            length = min(end - start, self.size)
            if length == self.size:
                window = self._window()
            else:
                fits = [w for w in self.open if w.used + length <= self.size]
                window = max(fits, key=lambda w: w.used) if fits else None
                if window is None and len(self.open) >= self.keep:
                    fullest = max(self.open, key=lambda w: w.used)
                    room = self.size - fullest.used
                    if room >= self.min_cut:
                        fullest.add(piece(start, start + room), room)
                        start += room
                    self.open.remove(fullest)
                    self._emit(fullest)
                    continue
                if window is None:
                    window = self._window()
                    self.open.append(window)
            window.add(piece(start, start + length), length)
            start += length
            if window.used == self.size:
                if window in self.open:
                    self.open.remove(window)
                self._emit(window)

    def leftovers(self) -> None:
        for window in self.open:
            self.done += [(*p, window.used) for p in window.pieces]


def _pack(path: str | None, size: int, keep: int, min_cut: int, with_ids: bool):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [*[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        values = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
        by_name = dict(zip(["doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens", "sequence_id", "offset", "fill"], values))
        return pa.RecordBatch.from_arrays([by_name[c] for c in _COLUMNS], names=_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.load(path, KEPT)
        end_id = END.to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << 32, size, keep, min_cut)
        for rows in batches:
            for doc_id, packed in zip(rows.column("doc_id").to_pylist(), encoder.column(rows.column("text"))):
                packed += end_id
                total = len(packed) // 4

                def piece(start: int, end: int, doc_id=doc_id, packed=packed, total=total) -> tuple:
                    ids = packed[4 * start : 4 * end]
                    return doc_id, start, end - start, zlib.crc32(ids), ids if with_ids else None, total

                packer.place(piece, 0, total)
                if len(packer.done) >= 2_000:
                    yield batch(packer.done)
                    packer.done = []
        packer.leftovers()
        if packer.done:
            yield batch(packer.done)

    return run


def _merge(size: int):
    def run(windows: pd.DataFrame) -> pd.DataFrame:
        """Best fit, fullest first: where each leftover window moves."""
        windows = windows.sort_values(["fill", "sequence_id"], ascending=[False, True])
        free: list[tuple[int, int]] = []
        out = []
        for number, fill in zip(windows["sequence_id"].tolist(), windows["fill"].tolist()):
            at = bisect_left(free, (fill, -1))
            if at < len(free):
                room, target = free.pop(at)
            else:
                room, target = size, number
            out.append((number, target, size - room))
            insort(free, (room - fill, target))
        return pd.DataFrame(out, columns=["sequence_id", "target", "shift"])

    return run


def pack(
    spark: SparkSession, docs: DataFrame, size: int = SIZE, open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT, tokenizer: str | None = None, with_ids: bool = True
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, unless ``with_ids`` is
    off, the packed ``ids``."""
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(texts(docs).mapInArrow(_pack(tokenizer, size, open_windows, min_cut, with_ids), _SCHEMA), "pieces")
    windows = pieces.where("fill is not null").groupBy("sequence_id").agg(F.max("fill").alias("fill"))
    windows = scratch.keep(windows, "windows")
    groups = max(1, -(-windows.count() // MERGE))
    dealt = windows.withColumn("deal", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    moved = dealt.groupBy("deal").applyInPandas(_merge(size), "sequence_id long, target long, shift long")
    names = [c for c in _COLUMNS if c not in ("fill", "ids")] + ["ids"] * with_ids
    closed = pieces.where("fill is null").select(*names)
    left = pieces.where("fill is not null").join(moved, "sequence_id")
    left = left.withColumn("sequence_id", F.col("target")).withColumn("offset", F.col("offset") + F.col("shift")).select(*names)
    return closed.unionByName(left)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences of pieces that carry ids: ``sequence_id``, ``n_tokens``
    and the packed ``ids`` (a sequence is bounded by its window)."""
    parts = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return parts.select("sequence_id", "n_tokens", joined.alias("ids"))


def ids_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")
