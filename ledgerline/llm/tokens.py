"""Token ids of whole texts with the ``tokenizers`` library.

The byte-level vocabulary splits a text before every single space that stands
between two non-space characters and on both sides of a lone line feed, so the
ids of a text are those of the pieces in between, in order. Each worker keeps
the ids of pieces it has met, in two generations of ``CACHE`` pieces, and asks
the tokenizer for new ones alone: a piece of letters goes straight to the
tokenizer's BPE model, one with a closing mark is its letters and the mark,
and anything else takes the whole tokenizer. The vocabulary's added tokens are met
in a text as the tokenizer meets them: it is split at their contents first, or
goes to the whole tokenizer if one of them takes more than its content.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa

from ledgerline.llm.hashing import byte_view, spans_of_rows

VOCABULARY = "byte_bpe_50k.json"
CACHE, LONG, STRETCH = 50_000, 64, 1 << 20
MARKS, PLAIN_END = (".", ",", ";", ":", "!", "?"), "\u0250"
_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others follow U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class _Pieces(dict):
    """Packed ids by piece, filled as pieces are met. ``lead`` goes before
    each piece (the space that was split off)."""

    def __init__(self, encoder: "Encoder", lead: str):
        super().__init__()
        self.encoder, self.lead, self.old = encoder, lead, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if piece.isalpha() and (piece.isascii() or max(piece) < PLAIN_END):
                ids = self.encoder.letters(self.lead + piece)
            elif piece[-1:] in MARKS and piece[:-1].isalpha():
                ids = self[piece[:-1]] + self.encoder.whole(piece[-1])
            else:
                ids = self.encoder.whole(self.lead + piece)
        if len(piece) <= LONG:
            self[piece] = ids
        return ids

    def turn(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


def _stretches(text: str) -> Iterator[str]:
    """A long text cut where its ids are cut anyway."""
    low = 0
    while low < len(text):
        cut = _CUT.search(text, low + STRETCH - 1)
        high = cut.start() if cut else len(text)
        yield text[low:high]
        low = high


class Encoder:
    """Packed little-endian unsigned 32-bit ids of texts."""

    _loaded: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: array("I", [k]).tobytes() for k, t in added.items()}
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        # the longest of those that begin at one place
        contents = map(re.escape, sorted(self.added, key=len, reverse=True))
        self.split = re.compile(f"({'|'.join(contents)})") if added else None
        self.byte_letters = _byte_letters()
        self.first, self.spaced = _Pieces(self, ""), _Pieces(self, " ")

    @classmethod
    def load(cls, path: str | None) -> "Encoder":
        """One per Python worker: its cache lasts from task to task."""
        path = path or default_path()
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """Of one word, which the vocabulary's rule never splits."""
        as_letters = word.encode().decode("latin-1").translate(self.byte_letters)
        return array("I", [t.id for t in self.model.tokenize(as_letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        if self.split is None or not self.split.search(text):
            return self._between(text)
        if not self.plain:
            return self.whole(text)
        parts = self.split.split(text)
        return b"".join(self.added[p] if k % 2 else self._between(p) for k, p in enumerate(parts))

    def _between(self, text: str) -> bytes:
        """Of a text, or a part of one, without added tokens."""
        if len(text) <= STRETCH:
            return self._encode(text)
        return b"".join(map(self._encode, _stretches(text)))

    def _encode(self, text: str) -> bytes:
        self.first.turn()
        self.spaced.turn()
        if _RUN.search(text):
            first, *rest = _CUT.split(text)
            return self.first[first] + b"".join(map(self.spaced.__getitem__, rest))
        out: list[bytes] = []
        feed = self.first["\n"]
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(feed)
            words = line.split(" ")
            out.append(self.first[words[0]])
            out.extend(map(self.spaced.__getitem__, words[1:]))
        return b"".join(out)


def encode_column(column: pa.Array, encoder: Encoder, span: int = 1 << 20) -> Iterator[bytes]:
    """Packed ids of each row in order (a null is an empty text), a bounded
    span of texts at a time."""
    _, starts = byte_view(column)
    for low, high in spans_of_rows(starts, span):
        for text in column.slice(low, high - low).to_pylist():
            yield encoder.encode(text or "")
