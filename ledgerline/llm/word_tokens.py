"""Token ids of columns of texts, a span of rows at a time.

A vocabulary cuts a text into runs that it encodes by themselves; both
vocabularies here do so at single spaces and line feeds, so a span of texts is
split there in Arrow, its distinct chunks are found (``dictionary_encode``),
only those are looked at in Python, and the ids of all chunks are gathered by
array operations.

``WordTokens`` is the lower-casing word vocabulary: white space is dropped, and
runs of letters, single digits and runs of anything else stand for themselves
(``byte_tokens`` has the byte-level one).
Each worker keeps the ids of runs it has met, in two generations of ``CACHE``;
a run of ASCII and Latin letters, digits or signs it has not met goes straight
to the tokenizer's BPE model, and any other chunk (apostrophes, added tokens,
other scripts) takes the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.hashing import byte_view, spans_of_rows
from ledgerline.llm.tokens import _byte_letters

VOCABULARY = "word_bpe_49k.json"
CACHE, LONG, SPAN = 700_000, 64, 2 << 20
MARKS = (".", ",", ";", ":", "!", "?")
_GAP = re.compile(r"[ \n]")
_SIMPLE = re.compile("[!-&(-~À-ÿ]+")
_RUNS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^0-9A-Za-zÀ-ÖØ-öø-ÿ]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def gather(packed: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries ``at`` of ``packed`` one after another, and how many
    there are before each (and in all)."""
    every = np.frombuffer(b"".join(packed), dtype="<u4")
    sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
    ends = np.cumsum(sizes)
    own = sizes[at]
    before = np.concatenate([[0], np.cumsum(own)])
    # the source of each id: its entry's start, then one further per id
    step = np.arange(before[-1]) + np.repeat((ends - sizes)[at] - before[:-1], own)
    return every[step], before


def chunks_of(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of texts split at spaces, the part at each place in
    order, and places before each text (and in all)."""
    split = pc.split_pattern(column, " ")
    before = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())]).astype(np.int64)
    parts = split.flatten().dictionary_encode()
    # no part holds a space: one text cut again is faster than a list of scalars
    one = pa.ListArray.from_arrays([0, len(parts.dictionary)], parts.dictionary.cast(pa.string()))
    return pc.binary_join(one, " ")[0].as_py().split(" "), parts.indices.to_numpy(), before


class Kept(dict):
    """Packed ids by text, filled by ``make`` as texts are met, in two
    generations of ``size`` (``CACHE``) texts."""

    def __init__(self, make, size: int | None = None):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= LONG:
            self[text] = ids
        return ids

    def turn(self) -> None:
        if len(self) > (self.size or CACHE):
            self.old = dict(self)
            self.clear()


class WordTokens:
    """Packed little-endian unsigned 32-bit ids of texts."""

    _loaded: dict[str, "WordTokens"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.byte_letters = _byte_letters()
        self.runs = Kept(self._run)

    @classmethod
    def load(cls, path: str | None) -> "WordTokens":
        """One per Python worker: what it keeps lasts from task to task."""
        path = path or default_path()
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _run(self, run: str) -> bytes:
        """Of one run in lower case, which the vocabulary's rule never cuts."""
        as_letters = run if run.isascii() else run.encode().decode("latin-1").translate(self.byte_letters)
        return array("I", [t.id for t in self.model.tokenize(as_letters)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Of a text without spaces and line feeds."""
        if chunk.isalpha() and (chunk.isascii() or max(chunk) <= "ÿ"):
            return self.runs[chunk.lower()]
        if chunk[-1:] in MARKS and chunk[:-1].isalpha() and (chunk.isascii() or max(chunk) <= "ÿ"):
            return self.runs[chunk[:-1].lower()] + self.runs[chunk[-1]]
        if not _SIMPLE.fullmatch(chunk) or ("|" in chunk and any(a in chunk for a in self.added)):
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.runs.__getitem__, _RUNS.findall(chunk.lower())))

    def _span(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a few texts, and ids before each text."""
        self.runs.turn()
        distinct, places, rows = chunks_of(pc.replace_substring(column, "\n", " "))
        ids, before = gather([self.chunk(c) for c in distinct], places)
        return ids, before[rows]

    def column(self, column: pa.Array) -> Iterator[bytes]:
        """Of each text of a column in order (a null is an empty text)."""
        _, starts = byte_view(column)
        column = column.cast(pa.large_string()).fill_null("")
        for low, high in spans_of_rows(starts, SPAN):
            part = column.slice(low, high - low)
            if high == low + 1 and starts[high] - starts[low] > SPAN:
                stretches = pa.array(list(_stretches(part[0].as_py())), pa.large_string())
                yield b"".join(self._span(stretches.slice(k, 1))[0].tobytes() for k in range(len(stretches)))
                continue
            ids, rows = self._span(part)
            for k in range(high - low):
                yield ids[rows[k] : rows[k + 1]].tobytes()


def _stretches(text: str) -> Iterator[str]:
    """A long text cut at spaces and line feeds."""
    low = 0
    while low < len(text):
        cut = _GAP.search(text, low + SPAN - 1)
        high = cut.end() if cut else len(text)
        yield text[low:high]
        low = high
