"""The divergence audit against plain Python over whole vocabularies."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import divergence
from ledgerline.llm.divergence import intern_trees, price_pair, shares

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = TERM.findall((r["text"] or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= divergence.MIN_DOCS)
        sources = sorted(s for g, s in groups if g == lang)
        both = Counter()
        for s in sources:
            both.update({t: counts[lang, s][t] for t in kept})

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(both)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, divergence.TOP)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:top])]
    return Counter(out)


def rows_of(df):
    return Counter((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("terms", [1, 2, 3, 8, 37, 200])
def test_trees_price_like_plain_sums(terms):
    rng = np.random.default_rng(terms)
    counts = rng.geometric(0.6, size=(6, terms)) - 1
    counts[2] = 0
    counts[4] = counts[3]
    leaves, levels = intern_trees(counts)
    totals = counts.sum(axis=1).tolist()
    p = [shares(leaves, n, terms) for n in totals]
    plain = [shares(row, n, terms) for row, n in zip(counts, totals)]
    for a in range(6):
        for b in range(6):
            there, here = price_pair(levels, a, b, p[a], p[b])
            assert there == sum((int(x) - int(y)) ** 2 // int(y) for x, y in zip(plain[a], plain[b]))
            assert here == sum((int(x) - int(y)) ** 2 // int(x) for x, y in zip(plain[a], plain[b]))
    assert levels[-1][3] == levels[-1][4]  # equal counts are one tree


def test_equal_subtrees_are_one_node():
    counts = np.zeros((3, 4096), dtype=np.int64)
    counts[:, 0] = [1, 2, 3]
    _, levels = intern_trees(counts)
    assert [len(level) for level in levels] == [4] * 11 + [3, 3]  # the zero subtree and one path per source
    assert len({int(x) for x in levels[-1][:, 0]}) == 3


def test_shares_are_exact_beyond_64_bits():
    assert shares(np.array([10**17]), 3 * 10**17, 7).tolist() == [1 + 10**9 * (10**17 + 1) // (3 * 10**17 + 7)]


def test_documents(spark, documents):
    assert rows_of(divergence.audit(spark, documents)) == brute(documents.collect())


def test_many_blocks_and_flushes(spark, documents, monkeypatch):
    monkeypatch.setattr(divergence, "LEAVES", 64)
    monkeypatch.setattr(divergence, "STRETCH", 100)
    part = documents.where("doc_id % 3 = 0")
    assert rows_of(divergence.audit(spark, part)) == brute(part.collect())


def test_partial_counts_add_up():
    import pyarrow as pa

    rng = random.Random(1)
    rows = [{"lang": "en", "source": f"s{k % 3}", "text": " ".join(rng.choice(["a", "Bb", "ñandú", "ÉÉ", "c3d"]) for _ in range(50))} for k in range(40)]
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 5]) for k in range(0, 40, 5)]
    got = Counter()
    for batch in divergence._count(iter(batches)):
        for r in batch.to_pylist():
            got[r["source"], r["term"]] += r["n"]
    want = Counter((r["source"], t) for r in rows for t in TERM.findall(r["text"].translate(LOWER)))
    assert +got == want


def test_odd_rows(spark, odd):
    rows = odd.unionByName(odd).unionByName(odd)
    assert rows_of(divergence.audit(spark, rows)) == brute(rows.collect())
    alone = divergence.audit(spark, odd)  # no term in three rows of a language but those of repeated words
    assert rows_of(alone) == brute(odd.collect())


def test_groups_without_terms_and_an_empty_table(spark, empty):
    rows = spark.createDataFrame([(1, "123", "en", "a", 3), (2, None, "en", "b", 0), (3, "x y", None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(divergence.audit(spark, rows)) == Counter({("en", "a", "pair", "b", 0, 1): 1, ("en", "b", "pair", "a", 0, 1): 1})
    out = divergence.audit(spark, empty)
    assert out.collect() == [] and out.columns == ["lang", "source", "part", "item", "value", "rank"]
