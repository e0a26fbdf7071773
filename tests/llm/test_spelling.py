"""Spelling variants against all pairs of words, by plain edit rules."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import spelling
from ledgerline.llm.common import Scratch

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def counted(rows):
    words = Counter()
    for r in rows:
        doc_id = "" if r["doc_id"] is None else r["doc_id"]
        for run in RUN.findall(r["text"] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    """All texts one edit away, by making them."""
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    made = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return made - {word}


def brute(words):
    letters = sorted(set("".join(words)))
    out, forms = {}, {}
    for word, n in words.items():
        near = edits(word, letters) & words.keys()
        best = min(near, key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best is not None and words[best] >= 2 * n else None
        out[word] = len(near)
    rows = Counter()
    for word, n in words.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows[word, forms[word], root, n, out[word], words.get(forms[word])] += 1
    return rows


def rows_of(df):
    return Counter((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    return b in edits(a, set(a + b))


def test_tiles_find_single_edits():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab"), size=rng.integers(5, 8))) for _ in range(300)} | {"aaaaa", "aaaaaa", "aaaaaaa"})
    points, size = spelling._matrix(words)
    one, other, prefix = spelling.near_tile(points, size, points, size)
    got = set(zip(one.tolist(), other.tolist()))
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}
    for i, j, k in zip(one, other, prefix):
        assert words[i][:k] == words[j][:k] and words[i][k : k + 1] != words[j][k : k + 1]


def test_documents(spark, documents):
    assert rows_of(spelling.group_variants(spark, documents)) == brute(counted(documents.collect()))


@pytest.mark.parametrize("block", [2, 7, 1024])
def test_crowded_blocks_lose_no_pair(spark, monkeypatch, block):
    """Words of one long common part, in blocks that have to be halved."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = np.random.default_rng(block)
    words = {"stem" + "".join(rng.choice(list("abé"), size=rng.integers(2, 6))) + "ending" * int(rng.integers(0, 2)): int(rng.integers(3, 400)) for _ in range(400)}
    words |= {"".join(rng.choice(list("xy"), size=rng.integers(5, 8))): int(rng.integers(3, 400)) for _ in range(200)}
    near = spelling.near_words(Scratch(spark, "near"), spark.createDataFrame(list(words.items()), "word string, n long"))
    letters = sorted(set("".join(words)))
    want = {}
    for word in words:
        found = edits(word, letters) & words.keys()
        if found:
            best = min(found, key=lambda w: (-words[w], w))
            want[word] = (len(found), best, words[best])
    assert {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in near.collect()} == want


def test_long_words_and_chains(spark):
    long = "ab" * 300
    texts = [f"{long} " * 3 + f"{long}c " * 9, "aaaaa " * 3 + "aaaaaa " * 6 + "aaaaaaa " * 12 + "aaaaaaaa " * 24 + "aaaaaaaaa " * 48, "Éclair éclair éclair " * 2 + "eclair " * 9]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts, 7)], "doc_id long, text string")
    got = rows_of(spelling.group_variants(spark, docs))
    assert got == brute(counted(docs.collect()))
    roots = {r[0]: r[2] for r in got}
    assert roots["aaaaa"] == roots["aaaaaaaa"] == "aaaaaaaaa" and roots[long] == long + "c"


def test_a_very_long_word(spark):
    long = "ab" * 100_000
    words = spark.createDataFrame([(long, 3), (long + "c", 9), (long[:-1] + "x", 4), ("short", 3)], "word string, n long")
    near = {r["word"][-3:]: (r["n_near"], r["best"][-3:], r["best_n"]) for r in spelling.near_words(Scratch(spark, "near"), words).collect()}
    assert near == {"bab": (2, "abc", 9), "abc": (1, "bab", 3), "bax": (1, "bab", 3)}


def test_odd_rows(spark, odd, empty):
    rows = odd.unionByName(odd).unionByName(odd)
    assert rows_of(spelling.group_variants(spark, rows)) == brute(counted(rows.collect()))
    out = spelling.group_variants(spark, empty)
    assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
