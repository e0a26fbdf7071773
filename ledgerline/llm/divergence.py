"""Source divergence audit (operator 12): how the term shares of a source
differ from those of each other source of its language, and of the language.

A language keeps the terms that occur in ``MIN_DOCS`` or more of its rows. A
group (a source of a language, or the language itself) gives a kept term with
``count`` occurrences the share ``p = 1 + 1e9 * (count + 1) div (N + V)`` (``N``
occurrences of kept terms, ``V`` kept terms); the price of a term between
shares ``p`` and ``q`` is ``(p - q)^2 div q``. A pair of sources costs the sum
over all kept terms, terms that neither has included.

The sums come from hash-consed segment trees. A language's terms are dealt to
blocks of about ``LEAVES`` terms; in a block, the counts of each source are the
leaves of a segment tree over the block's term ids, and equal subtrees, of one
source or several, are one node (``intern_trees``). ``price_pair`` walks two trees
together from the roots, a level at a time, keeps every pair of nodes it meets
once, prices distinct pairs of leaves, and adds up on the way back: a pair of
equal subtrees met in many places, such as the many stretches of terms that two
sources lack, is priced once. Terms are ordered in a block by total count, so
that rare ones, whose counts are mostly zero, stand together.

On Spark: a partition counts the terms of its rows by language and source
before anything is shuffled; a term's counts meet by ``(language, term)``; the
blocks are tasks of their own, so no language or source is gathered in one, and
emit one row per pair of sources. The strongest terms of each source are a
window with a partial limit of ``TOP`` rows per group before its shuffle.

Null text, language and source read as empty texts. Every (language, source)
that occurs is a group, also without any kept term (its shares are then
``1 + 1e9 div V``, or no terms at all: value 0). Repeated rows count as rows of
their own. A language of one source has no pairs. Ties rank by the item's UTF-8
bytes. Empty table: no rows. Other columns are not looked at. All arithmetic is
exact: counts are longs, products of shares stay below 2^63, and the division
behind a share is done on integers of any size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, reach_workers

MIN_DOCS, TOP, LEAVES, UNIT = 3, 200, 8192, 1_000_000_000
HELD, STRETCH = 600_000, 1 << 20
# Terms: maximal runs of ASCII letters and of all characters beyond ASCII, on
# UTF-8 bytes in which A-Z are lower-cased.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")
_COUNTS = "lang string, source string, term string, n long, docs long"


def _terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded stretch of it at a time."""
    low = 0
    while low < len(raw):
        cut = _BREAK.search(raw, low + STRETCH - 1)
        high = cut.end() if cut else len(raw)
        yield _TERM.findall(raw[low:high].lower())
        low = high


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and rows of each term by language and source, combined
    until ``HELD`` of them are in memory; a group itself is the empty term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, source in sorted(held):
            n, docs = held[lang, source]
            terms = list(n)
            for low in range(0, len(terms), 50_000):
                part = terms[low : low + 50_000]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang), size), pa.repeat(pa.scalar(source), size), pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    for rows in batches:
        read = zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), rows.column("text").cast(pa.binary()).to_pylist())
        for lang, source, raw in read:
            n, docs = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
            if len(raw) <= STRETCH:
                terms = _TERM.findall(raw.lower())
                n.update(terms)
                docs.update(set(terms))
                continue
            once: set[bytes] = set()
            for terms in _terms(raw):
                n.update(terms)
                once.update(terms)
            docs.update(once)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from out()
    yield from out()


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The share of each count, exact (integers of any size on the way)."""
    return np.array([1 + UNIT * (int(c) + 1) // (total + kept) for c in counts], dtype=np.int64)


def intern_trees(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segment trees over the rows of ``counts`` (sources x terms) with shared
    nodes: the distinct counts (leaves), and by level, leaves first, a row per
    node with the numbers of its two children on the level below (-1: none, the
    last node of an odd level). The last level holds each source's root."""
    leaves, at = np.unique(counts, return_inverse=True)
    at = at.reshape(counts.shape)
    levels = []
    while at.shape[1] > 1:
        if at.shape[1] % 2:
            at = np.concatenate([at, np.full((len(at), 1), -1, dtype=at.dtype)], axis=1)
        pairs = (at[:, 0::2] << 32) | (at[:, 1::2] & 0xFFFFFFFF)
        nodes, at = np.unique(pairs, return_inverse=True)
        at = at.reshape(pairs.shape)
        right = nodes & 0xFFFFFFFF
        levels.append(np.stack([nodes >> 32, np.where(right == 0xFFFFFFFF, -1, right)], axis=1))
    levels.append(at)
    return leaves, levels


def price_pair(levels: list[np.ndarray], one: int, other: int, p: np.ndarray, q: np.ndarray) -> tuple[int, int]:
    """The cost between the trees of two sources, both ways, whose leaves have
    the shares ``p`` and ``q``."""
    *inner, roots = levels
    met = [(roots[one], roots[other])]
    back = []
    for nodes in reversed(inner):
        a, b = nodes[met[-1][0]].reshape(-1), nodes[met[-1][1]].reshape(-1)
        there = a >= 0
        keys = np.where(there, (a << 32) | b, -1)
        distinct, places = np.unique(keys, return_inverse=True)
        back.append((places, distinct[0] < 0))
        if distinct[0] < 0:
            distinct = distinct[1:]
        met.append((distinct >> 32, distinct & 0xFFFFFFFF))
    a, b = met[-1]
    gap = p[a] - q[b]
    there, here = gap * gap // q[b], gap * gap // p[a]
    for places, missing in reversed(back):
        both = []
        for value in (there, here):
            value = np.concatenate([[0], value]) if missing else value
            both.append(value[places].reshape(-1, 2).sum(axis=1))
        there, here = both
    return int(there[0]), int(here[0])


def _price_block(key, terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Costs between all sources of a language over one block of its terms."""
    groups = groups.sort_values("source")
    sources = groups["source"].tolist()
    counts = np.zeros((len(sources), 1), dtype=np.int64)
    out = []
    if len(terms):
        order = terms.groupby("term", sort=True)["n"].sum().sort_values(kind="stable").index
        counts = np.zeros((len(sources), len(order)), dtype=np.int64)
        row = pd.Index(sources).get_indexer(terms["source"])
        counts[row, order.get_indexer(terms["term"])] = terms["n"].to_numpy()
        leaves, levels = intern_trees(counts)
        p = [shares(leaves, n, v) for n, v in zip(groups["total"].tolist(), groups["kept"].tolist())]
    for one in range(len(sources)):
        for other in range(one + 1, len(sources)):
            there, here = price_pair(levels, one, other, p[one], p[other]) if len(terms) else (0, 0)
            out += [(key[0], sources[one], sources[other], there), (key[0], sources[other], sources[one], here)]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``,
    ``value``, ``rank``; terms to rank ``TOP``."""
    reach_workers(spark)
    scratch = Scratch(spark, "divergence")
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c), empty).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(_count, _COUNTS).repartition("lang", "term")
    summed = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # both read the one shuffle by language and term (its columns must be the same, so ``docs``
    # stays on both sides); the kept terms are the side that is hashed
    in_lang = summed.groupBy("lang", "term").agg(F.sum("docs").alias("lang_docs"), F.sum("n").alias("lang_n"))
    in_lang = in_lang.where((F.col("lang_docs") >= MIN_DOCS) | (F.col("term") == "")).drop("lang_docs")
    known = scratch.keep(summed.join(in_lang.hint("shuffle_hash"), ["lang", "term"]), "known")
    entries = known.where("term <> ''")

    languages = entries.groupBy("lang").agg(F.count_distinct("term").alias("kept"), F.sum("n").alias("lang_total"))
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = totals.join(languages, "lang", "left").select(
        "lang", "source", "total", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    groups = scratch.keep(groups.withColumn("blocks", F.ceil(F.greatest(F.col("kept"), F.lit(1)) / LEAVES)), "groups")

    blocks = groups.select("lang", "blocks").distinct()
    dealt = entries.join(blocks, "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source", "term", "n")
    priced = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "total", "kept")
    partial = dealt.groupBy("lang", "block").cogroup(priced.groupBy("lang", "block")).applyInPandas(
        _price_block, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def share(n: str, total: str) -> str:
        return f"1 + ((CAST({n} AS DECIMAL(20, 0)) + 1) * {UNIT}BD) div (CAST({total} AS DECIMAL(20, 0)) + kept)"

    found = entries.where("n > 0").join(groups.drop("blocks"), ["lang", "source"])
    found = found.select("lang", "source", F.col("term").alias("item"), F.expr(share("n", "total")).alias("p"), F.expr(share("lang_n", "lang_total")).alias("q"))
    found = found.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.unionByName(top.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
