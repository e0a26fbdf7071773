"""Benchmark decontamination by SimHash windows (operator 5).

Words are runs of letters, digits and non-ASCII characters, lower-cased in
A-Z; shingles are five words. For every benchmark item of ``m`` words, all
windows of ``m`` words of every text are in question; a text of fewer words
is one window, the whole of it:

1. A window of ``W`` shingles can only reach a weighted Jaccard similarity ``s``
   with an item of ``S`` shingles if at least ``s (W + S) / (1 + s)`` of its
   shingles occur in the benchmark at all. Prefix sums of those hits leave out
   every other window without loss.
2. The remaining windows get a 64-bit SimHash of their weighted shingles. Its
   bits are cut into ``RADIUS + 1`` blocks; fingerprints within ``RADIUS``
   agree on a block, so the blocks' tables find all item fingerprints within
   the radius. At a similarity of exactly 0.8 a window is farther than
   ``RADIUS`` with probability about 2e-6 (64 bits, 15 % of them expected to
   differ), and less above it. Of a window shorter than the item up to 19 % are
   expected to differ, so that its limit is ``SHORT_RADIUS``, with tables cut into
   as many blocks and one more.
3. The exact weighted-shingle similarity (sum of smaller over sum of larger
   counts, on the words themselves) verifies each candidate.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of text; each block's
index is broadcast to one pass over the documents. With more blocks than one a
pass is written and its broadcast freed before the next, so what is broadcast at
any time has a fixed bound.

Items or texts that are null, empty or shorter than five words match nothing.
The result has one row per document and item, the most similar window (ties:
the first). Rows that repeat a doc_id or item_id are each compared; equal
results fall together.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import hashing
from ledgerline.llm.common import Scratch, reach_workers, texts

SIMILARITY, RADIUS, SHORT_RADIUS, BITS = 0.8, 24, 30, 64
BLOCK_BYTES = 16 << 20
_SCHEMA = "doc_id long, item_id long, first_word long, n_words long, distance int, similarity double"


def simhash(shingles: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of shingle hashes (rows, shingles); a shingle that
    occurs twice weighs twice."""
    bits = np.unpackbits(np.ascontiguousarray(shingles).view(np.uint8).reshape(*shingles.shape, 8), axis=2, bitorder="little")
    ahead = 2 * bits.sum(axis=1, dtype=np.int32) > shingles.shape[1]
    return np.packbits(ahead, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _block_values(prints: np.ndarray, radius: int) -> list[np.ndarray]:
    """Values of ``radius + 1`` blocks of the bits, of which two fingerprints
    within the radius share one at least."""
    edges = [round(k * BITS / (radius + 1)) for k in range(radius + 2)]
    return [(prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def _tables(prints: np.ndarray, radius: int) -> list[dict[int, np.ndarray]]:
    return [{int(v): np.flatnonzero(values == v) for v in np.unique(values)} for values in _block_values(prints, radius)]


def need(window: int, item: int, similarity: float = SIMILARITY) -> int:
    """Shared shingles that a window and an item of so many shingles need."""
    return int(np.ceil(similarity * (window + item) / (1 + similarity) - 1e-9))


def weighted_similarity(a: list[bytes], b: list[bytes]) -> float:
    ca, cb = (Counter(zip(*(w[k:] for k in range(hashing.SHINGLE)))) for w in (a, b))
    least = sum(min(n, cb[g]) for g, n in ca.items())
    return least / (sum(ca.values()) + sum(cb.values()) - least)


def words_of(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hashing.word_bounds(raw, starts, hashing.NOT_WORD)


class Index:
    """One block of the benchmark."""

    def __init__(self, item_ids: list[int], column: pa.Array):
        raw, starts = hashing.byte_view(column)
        hashes, rows = hashing.word_hashes(raw, starts, hashing.NOT_WORD)
        shingles, at = hashing.shingle_hashes(hashes, rows)
        first, last, _ = words_of(raw, starts)
        lower = hashing.LOWER[raw].tobytes()
        self.items, self.words = [], []
        by_size = defaultdict(list)
        grams = []
        for k, item in enumerate(item_ids):
            size = int(rows[k + 1] - rows[k])
            if size < hashing.SHINGLE:
                continue
            own = shingles[at[k] : at[k + 1]]
            by_size[size].append((len(self.items), simhash(own[None, :])[0]))
            grams.append(own)
            self.items.append(item)
            self.words.append([lower[a:b] for a, b in zip(first[rows[k] : rows[k + 1]], last[rows[k] : rows[k + 1]])])
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, dtype=np.uint64)
        self.sizes = {}
        for size, entries in sorted(by_size.items()):
            where = np.array([e[0] for e in entries])
            prints = np.array([e[1] for e in entries], dtype=np.uint64)
            self.sizes[size] = (where, prints, {radius: _tables(prints, radius) for radius in (RADIUS, SHORT_RADIUS)})

    def near(self, size: int, prints: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int, int]]:
        """``(window, item, distance)`` of all items within the radius."""
        where, own, tables = self.sizes[size]
        values = _block_values(prints, radius)
        for k in range(prints.size):
            met = [t[int(v[k])] for t, v in zip(tables[radius], values) if int(v[k]) in t]
            if not met:
                continue
            found = np.unique(np.concatenate(met))
            apart = np.bitwise_count(own[found] ^ prints[k])
            for item, distance in zip(found[apart <= radius], apart[apart <= radius]):
                yield k, int(where[item]), int(distance)

    def search(self, shingles: np.ndarray, hits: np.ndarray, words) -> dict[int, tuple]:
        """Best verified window of one text for each item; ``words(i, j)``
        gives its words."""
        before = np.concatenate([[0], np.cumsum(hits)])
        best: dict[int, tuple] = {}
        for size in self.sizes:
            whole = size - hashing.SHINGLE + 1
            span = min(whole, shingles.size)
            least = need(span, whole)
            if least > span:
                break
            n_words, radius = span + hashing.SHINGLE - 1, RADIUS if span == whole else SHORT_RADIUS
            windows = np.flatnonzero(before[span:] - before[:-span] >= least)
            for low in range(0, windows.size, 256):
                at = windows[low : low + 256]
                prints = simhash(shingles[at[:, None] + np.arange(span)])
                for k, item, distance in self.near(size, prints, radius):
                    start = int(at[k])
                    score = weighted_similarity(words(start, start + n_words), self.words[item])
                    if score >= SIMILARITY and (item not in best or score > best[item][3]):
                        best[item] = (start, n_words, distance, score)
        return best


def _matches(index: Index, column: pa.Array) -> Iterator[tuple[int, int, tuple]]:
    """``(row, item, window)`` of every verified match in a column of texts."""
    raw, starts = hashing.byte_view(column)
    for low, high in hashing.spans_of_rows(starts):
        part, at = raw[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
        hashes, rows = hashing.word_hashes(part, at, hashing.NOT_WORD)
        shingles, begin = hashing.shingle_hashes(hashes, rows)
        spot = np.minimum(np.searchsorted(index.grams, shingles), max(index.grams.size - 1, 0))
        hits = index.grams[spot] == shingles if index.grams.size else np.zeros(shingles.size, dtype=bool)
        touched = np.unique(np.searchsorted(begin, np.flatnonzero(hits), side="right") - 1)
        if not touched.size:
            continue
        first, last, _ = words_of(part, at)
        lower = hashing.LOWER[part].tobytes()
        for row in touched.tolist():
            if rows[row + 1] - rows[row] < hashing.SHINGLE:
                continue
            base = int(rows[row])

            def words(i: int, j: int) -> list[bytes]:
                return [lower[a:b] for a, b in zip(first[base + i : base + j], last[base + i : base + j])]

            own = slice(begin[row], begin[row + 1])
            for item, hit in index.search(shingles[own], hits[own], words).items():
                yield low + row, index.items[item], hit


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            found = [(ids[row].as_py(), item, *hit) for row, item, hit in _matches(shared.value, batch.column("text"))]
            if found:
                columns = zip(*found)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()]
                names = ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return run


def _drop(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[row for row, _, _ in _matches(shared.value, batch.column("text"))]] = False
            yield batch.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The benchmark dealt to blocks of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))), blocks


def _index(items: DataFrame, block: int):
    """A block of the benchmark, broadcast."""
    own = items.where(F.col("block") == block).orderBy("item_id", "text").toArrow()
    return items.sparkSession.sparkContext.broadcast(Index(own.column("item_id").to_pylist(), own.column("text")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of a benchmark item:
    a filter of the rows as they are read, one pass per block of the
    benchmark, without a shuffle."""
    reach_workers(spark)
    items, blocks = _blocks(benchmark)
    scratch = Scratch(spark, "decontamination") if blocks > 1 else None
    for block in range(blocks):
        index = _index(items, block)
        docs = docs.mapInArrow(_drop(index), docs.schema)
        if scratch:
            docs = scratch.keep(docs, f"clean-{block}")
            scratch.drop(f"clean-{block - 1}")
            index.unpersist()
    return docs


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, distance, similarity)`` of
    every document that holds a passage of a benchmark item."""
    items, blocks = _blocks(benchmark)
    scratch = Scratch(spark, "decontamination") if blocks > 1 else None
    found = None
    for block in range(blocks):
        index = _index(items, block)
        part = texts(docs).mapInArrow(_scan(index), _SCHEMA)
        if scratch:
            part = scratch.keep(part, f"found-{block}")
            index.unpersist()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], _SCHEMA)
    best = F.max(F.struct(F.col("similarity"), -F.col("first_word"), -F.col("distance"), F.col("n_words"))).alias("best")
    rows = found.groupBy("doc_id", "item_id").agg(best)
    return rows.select("doc_id", "item_id", (-F.col("best.col2")).alias("first_word"), F.col("best.n_words"), (-F.col("best.col3")).cast("int").alias("distance"), F.col("best.similarity"))
