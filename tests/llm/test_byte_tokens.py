"""Ids of columns of texts equal those the tokenizer gives whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import byte_tokens, word_tokens
from ledgerline.llm.tokens import default_path

PARTS = ["a", "ab.", "ß!", "Dž", "ª", "½", "B", "1", " ", " ", "\n", "\t", "'s", ".", "é", "漢", "\xa0", "​", "\U0001f600", "\x85", "　", "\x1c", "<|endoftext|>", "a1b22,,c", "×÷", "\x00", "\x0b"]
EDGES = ["", " ", "a  b", " lead", "trail ", "a \nb", "a\n b", "x" * 200, "\n", "\nab\n", "a\nb c\nd", None]


@pytest.mark.parametrize("kind", [byte_tokens.ByteTokens, word_tokens.WordTokens])
def test_random_texts(kind, monkeypatch):
    path = default_path() if kind is byte_tokens.ByteTokens else word_tokens.default_path()
    plain, rng = Tokenizer.from_file(path), random.Random(3)
    texts = EDGES + ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 12))) for _ in range(3_000)]
    texts.append(" ".join(t or "" for t in texts))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for span, cache in ((1 << 20, 1 << 20), (50, 5)):
        monkeypatch.setattr(byte_tokens, "SPAN", span)
        monkeypatch.setattr(word_tokens, "SPAN", span)
        monkeypatch.setattr(word_tokens, "CACHE", cache)
        got = [np.frombuffer(p, "<u4").tolist() for p in kind(path).column(pa.array(texts))]
        assert got == want


def test_whole_documents(documents):
    plain = Tokenizer.from_file(default_path())
    texts = [r["text"] for r in documents.select("text").collect()]
    for text, packed in zip(texts, byte_tokens.ByteTokens.load(None).column(pa.array(texts))):
        assert np.frombuffer(packed, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids
