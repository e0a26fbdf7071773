"""Best-fit decreasing packing against one document at a time."""

import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bestfit, word_tokens
from ledgerline.llm.bestfit import OpenBins, best_fit_decreasing


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(word_tokens.default_path())


def one_by_one(lengths, size):
    """Sequences after placing each length by itself, and what is in them."""
    rooms, bins = [], []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, (length, -1))
        room, number = rooms.pop(at) if at < len(rooms) else (size, len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].append(length)
        bisect.insort(rooms, (room - length, number))
    return bins


def filled(steps, histogram):
    bins = {}
    for length, many in histogram.items():
        own = [s for s in steps if s[0] == length]
        for k in range(many):
            _, number, first, per_bin, offset = [s for s in own if s[1] <= k][-1]
            bins.setdefault(first + (k - number) // per_bin, []).append((offset + (k - number) % per_bin * length, length))
    return bins


@pytest.mark.parametrize("size", [5, 16, 50, 2048])
def test_runs_of_equal_pieces_are_placed_as_single_ones_would_be(size):
    rng = random.Random(size)
    for _ in range(60):
        lengths = [rng.randint(1, min(size, rng.choice([size, size // 2 + 1, 6]))) for _ in range(rng.randint(0, 300))]
        histogram = Counter(lengths)
        bins = filled(best_fit_decreasing(histogram, size), histogram)
        want = one_by_one(lengths, size)
        assert sorted(bins) == list(range(len(want)))
        for pieces in bins.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= size
        # equal rooms are interchangeable: which of them a piece goes to may differ
        assert Counter(sum(n for _, n in p) for p in bins.values()) == Counter(map(sum, want))


def test_steps_depend_on_the_size_alone():
    rng = random.Random(3)
    small = {k: rng.randint(1, 1_000) for k in range(1, 2049)}
    large = {k: rng.randint(1, 10**12) for k in range(1, 2049)}
    assert max(len(best_fit_decreasing(h, 2048)) for h in (small, large)) < 70_000


def test_the_tree_finds_the_tightest_capacity():
    rng = random.Random(4)
    bins, rooms = OpenBins(100), []
    for k in range(400):
        if rooms and rng.random() < 0.4:
            room = rng.choice(rooms)
            bins.take(room)
            rooms.remove(room)
        else:
            room = rng.randint(1, 100)
            bins.add(room, k, 1)
            rooms.append(room)
        length = rng.randint(1, 100)
        assert bins.tightest(length) == min((r for r in rooms if r >= length), default=None)


ODD = [
    "", "  ", "\n \n", "It's we'LL Ábc ²x ÷×Ç ŒÜß ﬁ İstanbul don't", "<|endoftext|> a<|startoftext|>b x\tz  y \x1c q\x85r 12345 a1b2--c3", None,
    "K Å ſ Σας ΣΑΣ　漢字 H̱ á Á ́", "word, word. word?! (word) \"word\" -- 'quoted' o'clock'", "\x00 ­​ \U0001f600\U0001f600",
]


def test_ids_are_the_tokenizers(plain, documents):
    import pyarrow as pa

    read = ODD + [r["text"] for r in documents.select("text").collect()]
    read.append(" ".join(t or "" for t in read) * (1 + 3 * word_tokens.SPAN // sum(len(t or "") for t in read)))
    encoder = word_tokens.WordTokens.load(None)
    for text, packed in zip(read, encoder.column(pa.array(read))):
        assert np.frombuffer(packed, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def check(spark, docs, plain, size):
    rows = docs.select("doc_id", "text").collect()
    want = Counter()
    lengths = []
    for r in rows:
        ids = np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [bestfit.END], dtype="<u4")
        for piece, low in enumerate(range(0, ids.size, size)):
            own = ids[low : low + size]
            want[r["doc_id"], piece, low, own.size, zlib.crc32(own.tobytes())] += 1
            lengths.append(own.size)
    out = bestfit.pack(spark, docs, size=size)
    got = out.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by_sequence = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    assert len(by_sequence) == len(one_by_one(lengths, size))
    return out


def test_documents_are_packed_whole(spark, documents, plain):
    out = check(spark, documents, plain, 2048)
    whole = bestfit.sequences(out)
    assert whole.where("n_tokens > 2048 or length(ids) <> 4 * n_tokens").isEmpty()
    assert whole.agg({"n_tokens": "sum"}).first()[0] == out.agg({"length": "sum"}).first()[0]


def test_odd_rows(spark, odd, plain):
    check(spark, odd, plain, 64)


def test_empty_table(spark, empty):
    out = bestfit.pack(spark, empty, with_ids=False)
    assert out.collect() == []
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
