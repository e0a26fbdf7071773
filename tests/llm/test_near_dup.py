"""SetSketch near-duplicates against brute force."""

import random
import re

import numpy as np

from ledgerline.llm import near_dup as N
from ledgerline.llm.common import Scratch, connected_components

from llm_support import docs


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def components(rows, percent=85):
    """``rows``: (doc_id, text). Every pair is compared."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[:k]:
            if sa and sb and min(len(sa), len(sb)) * 100 >= percent * max(len(sa), len(sb)) and 100 * len(sa & sb) >= percent * len(sa | sb):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), find(i)) for i, s in sets}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_documents_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    out = N.near_duplicates(spark, documents)
    assert answer(out) == components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for k in rng.sample(range(len(words)), edits):
            words[k] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_groups_of_copies_chains_and_near_misses(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{rng.randrange(4000)}" for _ in range(160)]
    texts = [" ".join(words)] * 40 + variants(rng, words, 60, 1) + variants(rng, words, 60, 2) + variants(rng, words, 40, 4)
    chain = [f"c{k}" for k in range(200)]
    texts += [" ".join(chain[k : k + 120]) for k in range(0, 60, 6)]
    texts += ["tiny text", "Tiny TEXT", "tiny", "", None, " ".join(words).upper()]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = components(rows)
    assert answer(N.near_duplicates(spark, docs(spark, texts))) == expected
    # the same by the paths of large buckets and large components
    monkeypatch.setattr(N, "BUCKET", 8)
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "BROADCAST_IDS", 0)
    assert answer(N.near_duplicates(spark, docs(spark, texts))) == expected


def test_sketches_merge_and_follow_similarity():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 4000, dtype=np.uint64) for _ in range(2))
    union = N.registers_of(np.concatenate([a, b]))
    assert (N.merge(N.registers_of(a), N.registers_of(b)) == union).all()
    agree = []
    for share in (0.0, 0.5, 0.9):
        same = int(4000 * 2 * share / (1 + share))
        c = np.concatenate([a[:same], b[: 4000 - same]])
        agree.append((N.registers_of(a) == N.registers_of(c)).mean())
    assert agree[0] < 0.05 and 0.3 < agree[1] < 0.7 and agree[2] > 0.8


def test_likelihood_keeps_links_and_drops_strangers():
    rng = np.random.default_rng(2)
    kept, sizes = [], np.array([500.0])
    for share, expected in ((0.85, True), (0.9, True), (0.3, False), (0.0, False)):
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            same = round(500 * 2 * share / (1 + share))
            a, b = N.registers_of(pool[:500]), N.registers_of(pool[500 - same : 1000 - same])
            found = N.plausible(np.array([(a > b).sum()]), np.array([(a < b).sum()]), sizes, sizes, 0.85)[0]
            kept.append(found == expected)
    assert all(kept)


def test_odd_and_empty_tables(spark, odd, empty):
    out = N.near_duplicates(spark, odd).collect()
    assert len(out) == odd.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(1, 5, True)] * 2
    assert by[None] == [(6, None, True)]
    assert N.near_duplicates(spark, empty).count() == 0


def test_words_that_collide_in_sums_stay_apart(spark):
    swap = str.maketrans("ab", "ba")
    word = "a"
    for _ in range(11):
        word += word.translate(swap)
    texts = [word, word.translate(swap), word.upper(), word[:1024], word[1024:], word[:1024].translate(swap)]
    out = answer(N.near_duplicates(spark, docs(spark, texts)))
    assert out == components(list(enumerate(texts)))


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    seen = []
    words = [f"w{k}" for k in range(60)]
    texts = {1: " ".join(words), 2: " ".join(words[:-1]), 3: " ".join(words[1:]).upper(), 4: "something else altogether that stands alone"}
    rows = [(i, t) for i, t in texts.items()] + [(2, texts[2])] * 3_000 + [(3, texts[3].lower())] * 50 + [(2, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    verify = N._verify

    def counted(percent):
        inner = verify(percent)

        def run(batches):
            held = list(batches)
            for key in {(c, i, j) for b in held for c, i, j in zip(*(b.column(k).to_pylist() for k in ("component", "i", "j")))}:
                size = sum(k == key for b in held for k in zip(*(b.column(n).to_pylist() for n in ("component", "i", "j"))))
                assert size <= 10, size
            yield from inner(iter(held))

        return run

    monkeypatch.setattr(N, "_verify", counted)
    out = N.near_duplicates(spark, df).collect()
    assert len(out) == len(rows)
    # the texts of id 2 are one document, which links 4 to the others
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out} == {(1, 56, 1), (2, 55, 1), (3, 55, 1), (4, 2, 1), (2, 2, 1)}


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.component for r in connected_components(df, Scratch(spark, "cc"), "t").collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def test_pipeline_stage_equals_brute_force_at_80(spark, documents):
    import corpus_pipeline as P

    rng = random.Random(12)
    first = documents.selectExpr("max(doc_id)").first()[0] + 1
    texts = []
    for group in range(30):
        words = [f"g{group}w{k}" for k in range(160)]
        texts.append(" ".join(words))
        for edits in (3, 4):  # similarities of 0.82 and 0.77
            for k in range(edits):
                words[10 + 40 * k] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    df = documents.select(*P.COLUMNS).unionByName(docs(spark, texts, first).select(*P.COLUMNS))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = {i for i, (_, component) in components(rows, 80).items() if i == component}
    assert len(want) < sum(i == component for i, (_, component) in components(rows, 85).items())
    kept = P.drop_near_duplicates(spark, df, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_bands_miss_less_than_stated():
    assert [N.band_rows(x) for x in (0.85, 0.8)] == [5, 4]
    for percent in range(30, 100):
        rows = N.band_rows(percent / 100)
        assert N.REGISTERS % rows == 0 and (1 - (percent / 100) ** rows) ** (N.REGISTERS // rows) < N.MISS
