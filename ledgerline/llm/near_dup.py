"""SetSketch near-duplicate detection (operator 8).

A document's set is its distinct five-word shingles (``hashing``). A SetSketch
holds, per register, the smallest of an exponential variate over the set,
kept as the integer exponent ``floor(1 - log_b(minimum))``: registers of two
sets merge by the larger value, and two sets agree on a register with a
probability that follows their Jaccard similarity.

1. Documents with equal sets fall into one class (128-bit key); classes are
   compared, not copies.
2. Registers are banded. Classes that agree on a whole band meet in a bucket;
   inside a bucket the pair's similarity is estimated from the counts of
   larger, smaller and equal registers by maximum likelihood (set sizes are
   known exactly), and pairs for which the threshold is implausible are left.
   A bucket above ``BUCKET`` members is linked to its smallest member without
   an estimate, which only widens the search.
3. The components of those candidates are dealt out in blocks bounded in rows
   and bytes; each pair of blocks compares full shingle sets, skipping pairs
   already linked, and emits a spanning forest of true links. Nothing is
   dropped or capped: a large component is more pairs of blocks.
4. The components of the true links are the result.

``REGISTERS`` are cut into bands of ``ROWS`` or, for a lower threshold, of fewer
registers, so that all bands miss a link at exactly the threshold with
probability below ``MISS``, and less above it: 24 bands of 5 at 0.85
((1 - 0.85^5)^24 = 8e-7), 30 bands of 4 at 0.8 ((1 - 0.8^4)^30 = 1e-7). The
likelihood test leaves a further five standard deviations.

Empty or null text: an empty set, linked with nothing, its own component. A
text of one to four words is one shingle. Rows that repeat a doc_id are one
document; each gets the same answer, and a class is compared once however often
its rows repeat. A null doc_id takes part in no link and
has a null component. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import hashing
from ledgerline.llm.common import Scratch, connected_components, sorted_groups, texts

REGISTERS, ROWS, MISS = 120, 5, 1e-6
BASE, SCALE, TOP = 1.001, 20.0, (1 << 16) - 2
BUCKET = 512
BLOCK_ROWS, BLOCK_BYTES = 256, 4 << 20
NATS = 12.5
BROADCAST_IDS = 2_000_000

_LANES = np.random.default_rng(8).integers(0, 1 << 32, size=REGISTERS, dtype=np.uint32) | np.uint32(1)
_SKETCH_SCHEMA = "doc_id long, n_shingles long, n_bytes long, key_a long, key_b long, registers binary, bands array<long>"


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """The SetSketch registers of a set of 64-bit shingle hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, values.size, 2048):
        np.minimum(low, (_LANES[:, None] * values[None, at : at + 2048]).min(axis=1), out=low)
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)
    level = np.floor(1.0 - np.log(least / SCALE) / np.log(BASE))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def band_rows(threshold: float) -> int:
    """Registers in a band: as many as miss a link at exactly ``threshold``
    with a probability below ``MISS``."""
    fits = [r for r in range(1, ROWS + 1) if REGISTERS % r == 0 and (1 - threshold**r) ** (REGISTERS // r) < MISS]
    return max(fits, default=1)


def _band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    keys = np.arange(1, REGISTERS // rows + 1, dtype=np.uint64) << np.uint64(40)
    for row in registers.reshape(-1, rows).T:
        keys = hashing.mix64(keys ^ row.astype(np.uint64))
    return keys.view(np.int64)


def _register_odds(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / np.log(BASE)


def plausible(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a similarity of ``threshold`` or more is plausible for each
    pair, given how many registers of ``a`` are above and below those of ``b``
    and both set sizes: the joint log-likelihood at or above the threshold is
    within ``NATS`` of its maximum."""
    share = (n_a / (n_a + n_b))[:, None]
    most = (np.minimum(n_a, n_b) / np.maximum(n_a, n_b))[:, None]
    grid = np.linspace(0.0, 1.0, 65)[None, :]
    j = grid * most
    up = np.clip(_register_odds(share - (1 - share) * j), 1e-9, 1)
    down = np.clip(_register_odds((1 - share) - share * j), 1e-9, 1)
    same = np.clip(1 - up - down, 1e-9, 1)
    equal = REGISTERS - above - below
    score = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal[:, None] * np.log(same)
    reach = np.where(j >= threshold - 1 / 64, score, -np.inf).max(axis=1)
    return (most[:, 0] >= threshold - 1e-9) & (reach >= score.max(axis=1) - NATS)


class Forest:
    """Union-find over positions; remembers the edges that joined two trees."""

    def __init__(self, n: int):
        self.root = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, a: int, b: int) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.root[max(ra, rb)] = min(ra, rb)
            self.edges.append((a, b))


def _likely_pairs(registers: np.ndarray, sizes: np.ndarray, threshold: float, cross: int = 0) -> Iterator[tuple[int, int]]:
    """Positions whose sketches allow the threshold, most alike first within a
    slice. ``cross``: only pairs between the first ``cross`` and the rest."""
    n = len(sizes)
    slice_rows = max(1, 32_768 // max(n, 1))
    for low in range(0, cross or n, slice_rows):
        a = np.arange(low, min(low + slice_rows, cross or n))
        ia, ib = np.meshgrid(a, np.arange(cross, n), indexing="ij")
        ia, ib = ia.ravel(), ib.ravel()
        ok = np.minimum(sizes[ia], sizes[ib]) >= threshold * np.maximum(sizes[ia], sizes[ib]) - 1e-9
        ok &= ia < ib
        ia, ib = ia[ok], ib[ok]
        if not ia.size:
            continue
        above = (registers[ia] > registers[ib]).sum(axis=1)
        below = (registers[ia] < registers[ib]).sum(axis=1)
        ok = plausible(above, below, sizes[ia].astype(float), sizes[ib].astype(float), threshold)
        ia, ib, apart = ia[ok], ib[ok], (above + below)[ok]
        order = np.argsort(apart, kind="stable")
        yield from zip(ia[order].tolist(), ib[order].tolist())


def _edges(ids: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.asarray(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[at[:, 0]], pa.int64()), pa.array(ids[at[:, 1]], pa.int64())], names=["a", "b"])


def _key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    key = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the key of their text's set."""
    for batch in batches:
        keys = [_key(shingles) for shingles in hashing.row_shingles(batch.column("text"))]
        for k, name in enumerate(("key_a", "key_b")):
            batch = batch.append_column(name, pa.array([key[k] for key in keys], pa.int64()))
        yield batch


def _sketch(band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = hashing.byte_view(batch.column("text"))
            rows: dict[str, list] = {k: [] for k in ("n", "a", "b", "registers", "bands")}
            for shingles in hashing.row_shingles(batch.column("text")):
                key_a, key_b = _key(shingles)
                registers = registers_of(shingles) if shingles.size else None
                rows["n"].append(shingles.size)
                rows["a"].append(key_a)
                rows["b"].append(key_b)
                rows["registers"].append(None if registers is None else registers.tobytes())
                rows["bands"].append(None if registers is None else _band_keys(registers, band))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(rows["n"], pa.int64()), pa.array(np.diff(starts), pa.int64()),
                    pa.array(rows["a"], pa.int64()), pa.array(rows["b"], pa.int64()),
                    pa.array(rows["registers"], pa.binary()), pa.array(rows["bands"], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "n_bytes", "key_a", "key_b", "registers", "bands"],
            )

    return run


def sketch(docs: DataFrame, threshold: float) -> DataFrame:
    """Set size, set key, registers and band keys of every document."""
    return texts(docs).mapInArrow(_sketch(band_rows(threshold)), _SKETCH_SCHEMA)


def _bucket_edges(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["band"]):
            ids = group.column("doc_id").to_numpy()
            sizes = group.column("n_shingles").to_numpy()
            registers = np.frombuffer(b"".join(group.column("registers").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            forest = Forest(len(ids))
            for a, b in _likely_pairs(registers, sizes, threshold):
                forest.join(a, b)
            if forest.edges:
                yield _edges(ids, forest.edges)

    return run


def _verify(percent: int):
    threshold = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["component", "i", "j"]):
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            order = np.argsort(group.column("block").to_numpy(), kind="stable")
            group = group.take(pa.array(order))
            ids = group.column("doc_id").to_numpy()
            cross = int((group.column("block").to_numpy() == i).sum()) if i != j else 0
            sets = list(hashing.row_shingles(group.column("text")))
            registers = np.stack([registers_of(s) for s in sets])
            sizes = np.array([s.size for s in sets])
            forest = Forest(len(ids))
            for a, b in _likely_pairs(registers, sizes, threshold, cross):
                if forest.find(a) != forest.find(b):
                    shared = np.intersect1d(sets[a], sets[b], assume_unique=True).size
                    if 100 * shared >= percent * (int(sizes[a]) + int(sizes[b]) - shared):
                        forest.join(a, b)
            if forest.edges:
                yield _edges(ids, forest.edges)

    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row per document;
    documents are linked when ``100 * intersection >= percent * union``."""
    scratch = Scratch(spark, "near-dup")
    threshold = percent / 100
    sketches = scratch.keep(sketch(docs, threshold), "sketches")
    sets = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("doc_id"))
    classes = scratch.keep(classes, "classes")
    heads = sets.join(classes, ["doc_id", "key_a", "key_b"], "left_semi").groupBy("doc_id", "key_a", "key_b").agg(
        *(F.first(c).alias(c) for c in ("n_shingles", "n_bytes", "registers", "bands")), F.count("*").alias("copies")
    )
    heads = scratch.keep(heads, "heads")

    banded = heads.select("doc_id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("members"), F.min("doc_id").alias("pivot")).where("members > 1")
    met = scratch.keep(banded.join(buckets, "band"), "met")
    small = met.where(F.col("members") <= BUCKET).select("doc_id", "band").join(heads.select("doc_id", "n_shingles", "registers"), "doc_id")
    small = small.repartition("band").sortWithinPartitions("band").mapInArrow(_bucket_edges(threshold), "a long, b long")
    large = met.where(F.col("members") > BUCKET).select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))
    near = connected_components(small.unionByName(large), scratch, "near")
    scratch.drop("met")

    near = near.withColumnRenamed("id", "doc_id")
    plan = heads.select("doc_id", "key_a", "key_b", "n_bytes").join(near, "doc_id")
    blocks = plan.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    plan = scratch.keep(plan.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")), "plan")
    wanted = plan.select("doc_id", "component", "blocks", "block").distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    own = texts(docs).join(wanted, "doc_id")
    repeated = heads.where("copies > 1").select("doc_id").distinct()
    if not repeated.isEmpty():
        again = own.join(repeated, "doc_id", "left_semi")
        again = again.mapInArrow(_keyed, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in again.schema)}, key_a long, key_b long")
        again = again.dropDuplicates(["doc_id", "key_a", "key_b"]).drop("key_a", "key_b")
        own = own.join(repeated, "doc_id", "left_anti").unionByName(again)
    dealt = own.select(
        "doc_id", "text", "component", "block",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j")))).alias("pair"),
    ).select("doc_id", "text", "component", "block", "pair.i", "pair.j")
    links = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(_verify(percent), "a long, b long")
    linked = connected_components(links, scratch, "linked").withColumnRenamed("id", "class_id")

    of_class = classes.withColumnRenamed("doc_id", "class_id").join(linked, "class_id", "left").select("key_a", "key_b", F.coalesce("component", "class_id").alias("component_id"))
    joined = sketches.select("doc_id", "n_shingles", "key_a", "key_b").join(of_class, ["key_a", "key_b"], "left")
    answer = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    result = joined.select("doc_id", "n_shingles", answer.alias("component_id"), F.col("doc_id").eqNullSafe(answer).alias("kept"))
    result = scratch.keep(result, "result")
    scratch.drop("sketches", "classes", "heads", "near-labels", "plan")
    return result
