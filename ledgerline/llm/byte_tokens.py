"""Token ids of columns of texts under the byte-level vocabulary.

The vocabulary cuts a text before every single space that stands between two
other characters and on both sides of a lone line feed, so the ids of a text
are those of the pieces in between. A span of texts is split there in Arrow;
only its distinct pieces, with or without their space, are looked at in Python,
and all ids are gathered by array operations (``word_tokens``). A piece of ASCII
and Latin letters, digits and signs is cut into its runs, each of which goes to
the tokenizer's BPE model once; any other takes the whole tokenizer. A text with
two white-space characters side by side, with an added token, or longer than a
span goes through ``tokens.Encoder`` by itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.hashing import byte_view, spans_of_rows
from ledgerline.llm.tokens import Encoder, default_path
from ledgerline.llm.word_tokens import MARKS, SPAN, Kept, chunks_of, gather

# What any reader of the vocabulary's rule may take for white space, twice.
_WIDE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"
_SIMPLE = re.compile(" ?[!-&(-~À-ÿ]+")
_RUNS = re.compile(" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[^ 0-9A-Za-zÀ-ÖØ-öø-ÿ]+)")


class ByteTokens:
    """Packed little-endian unsigned 32-bit ids of texts."""

    _loaded: dict[tuple[str, int | None], "ByteTokens"] = {}

    def __init__(self, path: str, kept: int | None = None):
        self.encoder = Encoder(path)
        self.runs = Kept(self._run, kept)

    @classmethod
    def load(cls, path: str | None, kept: int | None = None) -> "ByteTokens":
        """One per Python worker: what it keeps (``kept`` runs, twice) lasts from
        task to task."""
        key = path or default_path(), kept
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def _run(self, run: str) -> bytes:
        """Of one run, which the vocabulary's rule never cuts."""
        if run.isascii():
            as_letters = "\u0120" + run[1:] if run[0] == " " else run  # the letter that stands for a space
        else:
            as_letters = run.encode().decode("latin-1").translate(self.encoder.byte_letters)
        return array("I", [t.id for t in self.encoder.model.tokenize(as_letters)]).tobytes()

    def piece(self, piece: str) -> bytes:
        known = self.runs.get(piece)
        if known is not None:
            return known
        if piece[-1:] in MARKS and piece[-2:-1].isalnum():  # the mark is a run of its own
            known = self.runs.get(piece[:-1])
            if known is not None:
                return known + self.runs[piece[-1]]
        if not _SIMPLE.fullmatch(piece):
            return self.encoder.whole(piece)
        found = _RUNS.findall(piece)
        return self.runs[piece] if len(found) == 1 else b"".join(map(self.runs.__getitem__, found))

    def _span(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a few texts, and ids before each text."""
        self.runs.turn()
        distinct, places, rows = chunks_of(pc.replace_substring(column, "\n", " \n "))
        spaced = np.ones(places.size, dtype=np.int64)
        spaced[rows[:-1]] = 0  # the first of a text, a line feed, and what follows one
        if "\n" in distinct:
            feeds = np.flatnonzero(places == distinct.index("\n"))
            spaced[feeds] = 0
            spaced[feeds[feeds + 1 < places.size] + 1] = 0
        kinds = 2 * places.astype(np.int64) + spaced
        used = np.flatnonzero(np.bincount(kinds, minlength=2 * len(distinct)))
        at = np.zeros(2 * len(distinct), dtype=np.int64)
        at[used] = np.arange(used.size)
        ids, before = gather([self.piece(" " + distinct[k >> 1] if k & 1 else distinct[k >> 1]) for k in used.tolist()], at[kinds])
        return ids, before[rows]

    def column(self, column: pa.Array, span: int = SPAN) -> Iterator[bytes]:
        """Of each text of a column in order (a null is an empty text), up to
        ``span`` bytes of texts at a time."""
        _, starts = byte_view(column)
        column = column.cast(pa.large_string()).fill_null("")
        for low, high in spans_of_rows(starts, span):
            part = column.slice(low, high - low)
            alone = pc.match_substring_regex(part, _WIDE)
            for content in self.encoder.added:
                alone = pc.or_(alone, pc.match_substring(part, content))
            if starts[high] - starts[low] > span:
                alone = pa.array([True] * len(part))
            ids, rows = self._span(pc.if_else(alone, "", part))
            for k, by_itself in enumerate(alone.to_pylist()):
                yield self.encoder.encode(part[k].as_py()) if by_itself else ids[rows[k] : rows[k + 1]].tobytes()
