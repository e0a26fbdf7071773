"""Compression-band quality rules (operator 2).

A document's zstandard ratio (compressed over raw bytes) is held against the
band of its length: below it the text repeats itself, above it it is close to
random. Fixed chunks of ``CHUNK`` bytes are held against one band of their
own, and a document goes when more than ``CHUNK_SHARE`` of its bytes fall
outside, so a repetitive or incompressible stretch shows in a long text too.
The bytes behind the last whole chunk are judged by the text's last ``CHUNK``
bytes; a text shorter than a chunk by the band of its length alone, and one
under 128 bytes, whose ratio says nothing, by the base rules alone. The base
rules count words, symbols, repeated lines and repeated eight-word windows.

Words are runs of bytes other than ASCII white space, as they stand; equal
words are told by 64-bit hashes, equal lines by themselves. A null
or empty text has no words and fails the base rules. Rows are judged one by
one: repeated rows get equal results, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import hashing
from ledgerline.llm.common import texts

LEVEL, CHUNK, CHUNK_SHARE, CHUNK_BAND = 3, 1024, 0.25, (0.25, 0.85)
# Raw bytes up to (exclusive) -> lowest and highest ratio.
BANDS = (
    (128, 0.0, 2.0), (256, 0.35, 0.97), (512, 0.35, 0.90), (1024, 0.33, 0.82), (2048, 0.31, 0.74), (4096, 0.29, 0.70),
    (8192, 0.27, 0.67), (16384, 0.25, 0.65), (65536, 0.22, 0.64), (float("inf"), 0.18, 0.64),
)
WINDOW, MIN_WORDS, MAX_REPEAT = 8, 20, 30
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_bytes long, ratio double, low_chunks double, high_chunks double, verdict string"
)


def repeated_words(words: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more, given
    a hash per word. Windows get exact ranks by doubling: pairs, then fours,
    then eights."""
    size = words.size
    if size <= WINDOW:
        return 0
    rank, counts = np.unique(words, return_inverse=True, return_counts=True)[1:]
    span = 1
    while span < WINDOW and counts.max() > 1:
        keys = rank[:-span].astype(np.int64) * counts.size + rank[span:]
        rank, counts = np.unique(keys, return_inverse=True, return_counts=True)[1:]
        span *= 2
    if counts.max() == 1:
        return 0
    edge = np.zeros(size + 1, dtype=np.int64)
    again = np.flatnonzero(counts[rank] > 1)
    edge[again] += 1
    edge[again + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def measure(raw: bytes, hashes: np.ndarray, compressor) -> tuple:
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    # a code point is a byte that does not continue one
    points = int((np.frombuffer(raw, dtype=np.int8) >= -64).sum())
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    repeats = repeated_words(hashes)
    failed = hashes.size < MIN_WORDS or 100 * repeats > MAX_REPEAT * hashes.size
    ratio = len(compressor.compress(raw)) / len(raw) if raw else None
    # (end, bytes that no chunk before it judges)
    chunks = [(k, CHUNK) for k in range(CHUNK, len(raw) + 1, CHUNK)]
    if chunks and len(raw) % CHUNK:
        chunks.append((len(raw), len(raw) % CHUNK))
    judged = [(len(compressor.compress(raw[end - CHUNK : end])) / CHUNK, n) for end, n in chunks]
    low = sum(n for r, n in judged if r < CHUNK_BAND[0]) / len(raw) if chunks else 0.0
    high = sum(n for r, n in judged if r > CHUNK_BAND[1]) / len(raw) if chunks else 0.0
    _, least, most = next(b for b in BANDS if len(raw) < b[0])
    if ratio is None or failed:
        verdict = "base"
    elif ratio < least or low > CHUNK_SHARE:
        verdict = "repetitive"
    elif ratio > most or high > CHUNK_SHARE:
        verdict = "incompressible"
    else:
        verdict = "ok"
    return hashes.size, points - spaces, symbols, len(lines) - len(set(lines)), repeats, failed, verdict == "ok", len(raw), ratio, low, high, verdict


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.int64(), *[pa.float64()] * 3, pa.string()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    for batch in batches:
        found = []
        raw, starts = hashing.byte_view(batch.column("text"))
        for low, high in hashing.spans_of_rows(starts):
            part, at = raw[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
            words, rows = hashing.word_hashes(part, at, fold=False)
            found += [measure(part[at[k] : at[k + 1]].tobytes(), words[rows[k] : rows[k + 1]], compressor) for k in range(high - low)]
        if found:
            columns = zip(*found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names=names)


def compression_bands(docs: DataFrame) -> DataFrame:
    """One row of measures and the verdict for every document."""
    return texts(docs).mapInArrow(_run, _SCHEMA)
