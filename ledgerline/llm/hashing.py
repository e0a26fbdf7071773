"""Vectorised word and shingle hashing over Arrow string batches.

Words are maximal runs of bytes outside a set of separators: by default space
and ``\\t``..``\\r`` (the ASCII white space), or every ASCII character but
letters and digits, after lower-casing ``A``-``Z``. All are byte-wise rules,
so UTF-8 text needs no decoding. Words of up to eight bytes have hashes of
their own (one bijective mix of the bytes); up to ``CHAINED`` bytes, eight-byte
blocks are mixed one after the other; longer ones, which may be made to collide,
take a keyed BLAKE2b digest. So one pass of array operations hashes nearly every
word of a batch; shingle hashes combine five word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
SPAN_BYTES = 1 << 20

CHAINED = 32
_KEY = b"ledgerline words"
_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)  # masks of the first n bytes
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_WORD = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LANES = np.random.default_rng(20240117).integers(1, 1 << 63, size=SHINGLE + 1, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts (rows + 1
    entries). A null is an empty text."""
    column = pa.array(column) if not isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, at - at[0]


def spans_of_rows(starts: np.ndarray, limit: int = SPAN_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (one row at least)."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_bounds(raw: np.ndarray, starts: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and words before each row."""
    inside = ~between[raw]
    edge = np.zeros(raw.size + 1, dtype=bool)
    edge[starts] = True
    before = np.zeros(raw.size, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(raw.size, dtype=bool)
    after[:-1] = inside[1:]
    first = np.flatnonzero(inside & (~before | edge[:-1]))
    last = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return first, last, np.searchsorted(first, starts)


def _hash_words(letters: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each ``letters[first:last]``."""
    # No byte of UTF-8 text is 255: with one added, none is 0, so that the empty
    # places of a block tell words of different lengths apart.
    padded = np.zeros(letters.size + 8, dtype=np.uint8)
    np.add(letters, 1, out=padded[: letters.size])
    blocks = np.ndarray((letters.size + 1,), dtype="<u8", buffer=padded, strides=(1,))
    sizes = last - first
    out = mix64(blocks[first] & _BYTES[np.minimum(sizes, 8)])
    for at in range(8, CHAINED, 8):
        more = np.flatnonzero((sizes > at) & (sizes <= CHAINED))
        if not more.size:
            continue
        block = blocks[first[more] + at] & _BYTES[np.minimum(sizes[more] - at, 8)]
        out[more] = mix64(mix64(out[more] + _LANES[at // 8]) ^ block)
    for k in np.flatnonzero(sizes > CHAINED).tolist():
        digest = hashlib.blake2b(letters[first[k] : last[k]].tobytes(), digest_size=8, key=_KEY).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def word_hashes(raw: np.ndarray, starts: np.ndarray, between: np.ndarray = SPACE, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word in order (``fold``: of the word in lower case), and
    words before each row. A long text is hashed in stretches that end between
    words, so that the working arrays stay small."""
    found, at = [], []
    low = 0
    while low < raw.size:
        high = low + SPAN_BYTES
        if high < raw.size:
            gap = np.flatnonzero(between[raw[high : high + SPAN_BYTES]])
            high = raw.size if not gap.size and high + SPAN_BYTES >= raw.size else high + (int(gap[0]) if gap.size else SPAN_BYTES)
            while high < raw.size and not between[raw[high]]:
                high += 1
        high = min(high, raw.size)
        part = raw[low:high]
        own = starts[np.searchsorted(starts, low) : np.searchsorted(starts, high, side="right")] - low
        first, last, _ = word_bounds(part, np.unique(np.concatenate([[0], own])), between)
        found.append(_hash_words(LOWER[part] if fold else part, first, last))
        at.append(first + low)
        low = high
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(at), starts)


def shingle_hashes(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles, and shingles before each row.

    A row with one to four words has one shingle, the whole sequence.
    """
    n = words.size
    counts = np.diff(rows)
    short = (counts > 0) & (counts < SHINGLE)
    sizes = np.where(short, 1, np.maximum(counts - SHINGLE + 1, 0))
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(at[-1]), dtype=np.uint64)
    full = max(n - SHINGLE + 1, 0)
    rolled = np.zeros(full, dtype=np.uint64)
    for k in range(SHINGLE):
        rolled += words[k : k + full] * _LANES[k]
    long = np.flatnonzero(counts >= SHINGLE)
    if long.size:
        start = np.repeat(rows[long], sizes[long])
        step = np.arange(start.size) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        to = np.repeat(at[long], sizes[long])
        out[to + step] = rolled[start + step]
    for row in np.flatnonzero(short):
        own = words[rows[row] : rows[row + 1]]
        tagged = np.append(own * _LANES[: own.size], _LANES[SHINGLE:] * np.uint64(own.size))
        out[at[row]] = tagged.sum(dtype=np.uint64)
    return mix64(out), at


def row_shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row, in row order."""
    raw, starts = byte_view(column)
    for low, high in spans_of_rows(starts):
        part = raw[starts[low] : starts[high]]
        words, rows = word_hashes(part, starts[low : high + 1] - starts[low])
        shingles, at = shingle_hashes(words, rows)
        for k in range(high - low):
            yield np.unique(shingles[at[k] : at[k + 1]])
