"""Spelling variant grouping (operator 13): words one edit apart, and the
commoner word that each is taken for a form of.

A word is what a run of letters comes out as after a planted, reproducible
misspelling (``variant``), if it has ``MIN_LENGTH`` code points or more and occurs
``MIN_COUNT`` times or more. Two words are near if they differ by exactly one
inserted, deleted or replaced code point. A word's form is its near word with
the largest count (ties: the smallest in code-point order) if that is at least
``RATIO`` times its own; its root is where forms lead to in the end.

Near words are found by dense prefix-suffix tiling. The words of a block are the
rows of a matrix of code points, padded to one width; two blocks are compared
as a tile, all rows of one with all of the other at once: the lengths of the
common prefix and of the common suffix, and a pair is near if they add up to
the longer length less one, at least.

Which words share a block: for lengths ``m`` and ``m`` or ``m + 1``, an edit lies in
one of ``WINDOWS`` windows of the shorter word, and what is left of the window and
right of it is equal in both. So a word goes to a block per window, keyed by
what is outside of it, as a word of length ``m`` and as one of ``m + 1``; a pair
counts in the window that its common prefix ends in, hence once. A block that
holds more than ``BLOCK`` words has its window halved, in rounds, until it is
small or its window is one code point wide: then it holds words of one length
that differ in one place and of the next length that differ in two, at most a
few thousand whatever the corpus. So no task meets a large group, no pair is
left out and no group is compared with itself beyond that size.

On Spark: partitions count words before the shuffle; only words that occur
often enough go on; a block is a group of rows of one task; the near words of a
word are combined by partial aggregates; forms are followed by pointer
doubling, each round written before the next. Null text: no words; null
``doc_id``: an empty text in the misspelling rule. Repeated rows count as rows
of their own. Empty table: no rows. Other columns are not looked at. A very
long run is one word like any other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, reach_workers, sorted_groups

MIN_LENGTH, MIN_COUNT, RATIO, MODULUS = 5, 3, 2, 97
WINDOWS, BLOCK, TILE_CELLS = 3, 1024, 1 << 22
HELD, STRETCH = 600_000, 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
_BREAK = re.compile("[^a-zA-ZÀ-ÿ]")


def variant(run: str, seed: int) -> str:
    """A lower-cased run as it is counted; ``seed`` is the checksum of the
    document's id and a colon."""
    checksum = zlib.crc32(run.encode(), seed)
    if checksum % MODULUS:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def _stretches(text: str) -> Iterator[str]:
    low = 0
    while low < len(text):
        cut = _BREAK.search(text, low + STRETCH - 1)
        high = cut.end() if cut else len(text)
        yield text[low:high]
        low = high


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        words = list(held)
        for low in range(0, len(words), 50_000):
            part = words[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])
        held.clear()

    for rows in batches:
        for doc_id, raw in zip(rows.column("doc_id").to_pylist(), rows.column("text").cast(pa.binary()).to_pylist()):
            seed = zlib.crc32(b"%s:" % ("" if doc_id is None else str(doc_id)).encode())
            for text in _stretches(raw.lower().decode()):  # bytes: A-Z alone change
                for run, n in Counter(_RUN.findall(text)).items():
                    word = variant(run, seed)
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
            if len(held) > HELD:
                yield from out()
    yield from out()


def near_tile(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of two padded code-point matrices are one edit apart, and
    how long their common prefix is. The second matrix has words as long as
    those of the first, or longer."""
    width = max(a.shape[1], b.shape[1])
    lead = _common(a, b, width)
    tail = _common(_flushed(a, a_size), _flushed(b, b_size), width)
    longer = np.maximum(a_size[:, None], b_size[None, :])
    shorter = np.minimum(a_size[:, None], b_size[None, :])
    prefix = np.minimum(lead, shorter)
    near = (prefix + np.minimum(tail, shorter) >= longer - 1) & (longer - shorter <= 1) & ~((prefix == shorter) & (longer == shorter))
    one, other = np.nonzero(near)
    return one, other, prefix[one, other]


def _flushed(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows reversed: what was the end of a word comes first."""
    at = size[:, None] - 1 - np.arange(words.shape[1])[None, :]
    return np.where(at >= 0, np.take_along_axis(words, np.maximum(at, 0), axis=1), 0)


def _common(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Columns in which rows agree before they first differ."""
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    going = np.ones((len(a), len(b)), dtype=bool)
    for k in range(min(a.shape[1], b.shape[1])):
        going &= a[:, k][:, None] == b[:, k][None, :]
        if not going.any():
            break
        out += going
    return out


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in words], dtype=np.int64)
    points = np.array(words, dtype=f"<U{max(1, int(size.max()))}").view("<u4").reshape(len(words), -1)
    return points, size


def _compare(words: list[str], n: np.ndarray, blocks: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Of every word of a few blocks: its near words in them, in number, and
    the commonest."""
    points, size = _matrix(words)
    step = max(1, min(BLOCK, TILE_CELLS // points.shape[1]))
    short = np.flatnonzero(size == lengths)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for first in range(0, short.size, step):
        rows = short[first : first + step]
        # rows of the same blocks only, and each two of one length once
        reach = np.flatnonzero((blocks >= blocks[rows[0]]) & (blocks <= blocks[rows[-1]]))
        for begin in range(0, reach.size, step):
            against = reach[begin : begin + step]
            width = int(max(size[rows].max(), size[against].max()))
            one, other, prefix = near_tile(points[rows, :width], size[rows], points[against, :width], size[against])
            one, other = rows[one], against[other]
            counts = (blocks[one] == blocks[other]) & ((size[other] > size[one]) | (other > one))
            counts &= (prefix >= low[one]) & ((prefix < high[one]) | (high[one] == lengths[one]))
            found.append((one[counts], other[counts]))
    one = np.concatenate([x for x, _ in found]) if found else np.zeros(0, dtype=np.int64)
    other = np.concatenate([x for _, x in found]) if found else np.zeros(0, dtype=np.int64)
    source, target = np.concatenate([one, other]), np.concatenate([other, one])
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[target], -n[target], source))
    source, target = source[order], target[order]
    whose, at, many = np.unique(source, return_index=True, return_counts=True)
    best = target[at]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in whose], pa.string()), pa.array(many, pa.int64()), pa.array([words[k] for k in best], pa.string()), pa.array(n[best], pa.int64())],
        names=["word", "n_near", "best", "best_n"],
    )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive one after another; a tile takes small ones together, and
    a larger one by itself."""
    held: list[pa.Table] = []
    rows = cells = 0

    def tile() -> pa.RecordBatch:
        sizes = [len(t) for t in held]
        blocks = np.repeat(np.arange(len(held)), sizes)
        whole = pa.concat_tables(held)
        columns = [whole.column(c).to_numpy() for c in ("n", "m", "low", "high")]
        return _compare(whole.column("word").to_pylist(), columns[0], blocks, *columns[1:])

    for block in sorted_groups(batches, ["m", "key", "low", "high"]):
        if len(block) == 1:
            continue
        if held and (rows + len(block) > 128 or cells + len(block) * block.column("m")[0].as_py() > TILE_CELLS):
            yield tile()
            held, rows, cells = [], 0, 0
        held.append(block)
        rows += len(block)
        cells += len(block) * block.column("m")[0].as_py()
    if held:
        yield tile()


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with their window -> rows with the key of their block: what stands
    left of the window and, a code point further in the longer words, right."""
    right = F.expr("substring(word, high + 1 + (length(word) - m), length(word))")
    return rows.withColumn("key", F.xxhash64("m", "low", "high", F.expr("substring(word, 1, low)"), right))


def _windows(m: Column, low: Column, high: Column, parts: int) -> Column:
    """``parts`` windows of about the same width, of one code point at least."""
    width = high - low
    cuts = F.sequence(F.lit(0), F.lit(parts - 1))
    made = F.transform(cuts, lambda k: F.struct(
        m.alias("m"), (low + F.floor(width * k / parts)).cast("int").alias("low"), (low + F.floor(width * (k + 1) / parts)).cast("int").alias("high")))
    return F.filter(made, lambda w: w["high"] > w["low"])


def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best``, ``best_n`` of every word (``word``, ``n``)
    with a near word; the best is the commonest, then the smallest."""
    size = F.length("word")
    roles = F.filter(F.array(size, size - 1), lambda m: m >= MIN_LENGTH)
    rows = words.select("word", "n", F.explode(F.flatten(F.transform(roles, lambda m: _windows(m, F.lit(0), m, WINDOWS)))).alias("w")).select("word", "n", "w.*")
    ready = None
    turn = 0
    while True:
        rows = _keyed(rows)
        large = rows.where("high - low > 1").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK).select("key")
        large = scratch.keep(large, f"large-{turn}")
        last = large.isEmpty()
        small = rows if last else rows.join(large, "key", "left_anti").select(*rows.columns)
        ready = small if ready is None else ready.unionByName(small)
        if last:
            break
        halved = rows.join(large, "key", "left_semi").select("word", "n", F.explode(_windows(F.col("m"), F.col("low"), F.col("high"), 2)).alias("w"))
        rows = scratch.keep(halved.select("word", "n", "w.*"), f"halved-{turn}")
        turn += 1
    dealt = ready.repartition("key").sortWithinPartitions("m", "key", "low", "high", "word")
    found = dealt.mapInArrow(_near, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus")).alias("best_n"))


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word with a form, by pointer doubling: a
    form occurs twice as often at least, so a chain of forms is short."""
    at = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots-0")
    turn = 0
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = scratch.keep(moved, f"roots-{turn + 1}")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at, turn = moved.select("word", "root"), turn + 1


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words of the texts that occur often enough."""
    reach_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def group_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    scratch = Scratch(spark, "spelling")
    words = scratch.keep(count_words(docs), "words")
    near = words.join(near_words(scratch, words), "word", "left")
    commoner = F.col("best_n") >= RATIO * F.col("n")
    named = scratch.keep(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(commoner, F.col("best")).alias("form"), F.when(commoner, F.col("best_n")).alias("form_n")), "named")
    roots = _roots(scratch, named.where("form is not null"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
