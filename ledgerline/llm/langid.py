"""Byte-level language identification (operator 9).

A bidirectional gated recurrent network reads the bytes of a text in chunks of
``STEPS`` and labels every byte position with a distribution over languages;
the mean over all positions of the whole text is the document's distribution.
It is trained here, in numpy, by backpropagation through time.

Training reads only ``text`` and non-null ``lang`` of documents whose
``crc32(doc_id)`` modulo 4 is not 2, at most ``DOCS_PER_LANG`` documents of
each of at most ``LANGS`` languages (the smallest hashes of their ids), and of
each document at most ``SNIPPETS`` pieces of ``SNIPPET_CHARS`` characters:
those four numbers bound what reaches the driver. Prediction reads every byte
of every text and nothing but the text.

A null text, or one without a letter, is ``und`` with score 0, as is every
text if no labelled row exists. Repeated rows each get their own (equal) row;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import reach_workers, texts
from ledgerline.llm.hashing import byte_view

UNKNOWN = "und"
HELD_OUT = 2
DOCS_PER_LANG, LANGS, SNIPPETS, SNIPPET_CHARS = 1500, 64, 3, 96
HIDDEN, STEPS, PAD = 8, 64, 256
BATCH, UPDATES, RATE = 192, 260, 0.02
ROWS = 4096


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == HELD_OUT


class ByteGru:
    """Weights of one direction. The update and reset gates use the logistic
    function as ``(1 + tanh(x)) / 2`` with the half folded into the weights."""

    def __init__(self, rng: np.random.Generator):
        self.x = rng.normal(0, 0.3, (PAD + 1, 3 * HIDDEN)).astype(np.float32)
        self.h = (rng.normal(0, 1, (HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
        self.c = np.zeros(HIDDEN, dtype=np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.x, self.h, self.c]

    def forward(self, codes: np.ndarray, keep: list) -> np.ndarray:
        """States after each step for ``codes`` (steps, rows); ``keep`` gets
        what ``backward`` needs."""
        steps, rows = codes.shape
        out = np.empty((steps, rows, HIDDEN), dtype=np.float32)
        state = np.zeros((rows, HIDDEN), dtype=np.float32)
        for t in range(steps):
            x = self.x[codes[t]]
            pre = state @ self.h
            gates = np.tanh(x[:, : 2 * HIDDEN] + pre[:, : 2 * HIDDEN])
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            inner = pre[:, 2 * HIDDEN :] + self.c
            fresh = np.tanh(x[:, 2 * HIDDEN :] + reset * inner)
            keep.append((state, gates, inner, fresh))
            state = fresh + update * (state - fresh)
            out[t] = state
        return out

    def states(self, codes: np.ndarray) -> np.ndarray:
        """``forward`` for prediction: the same arithmetic with one contiguous
        array per gate and no allocation inside the loop."""
        steps, rows = codes.shape
        tables = [np.ascontiguousarray(self.x[:, k : k + HIDDEN]) for k in range(0, 3 * HIDDEN, HIDDEN)]
        square = [np.ascontiguousarray(self.h[:, k : k + HIDDEN]) for k in range(0, 3 * HIDDEN, HIDDEN)]
        out = np.empty((steps, rows, HIDDEN), dtype=np.float32)
        update, reset, fresh, spare = (np.empty((rows, HIDDEN), dtype=np.float32) for _ in range(4))
        state = np.zeros((rows, HIDDEN), dtype=np.float32)
        for t in range(steps):
            for gate, x, h in ((update, tables[0], square[0]), (reset, tables[1], square[1])):
                np.take(x, codes[t], axis=0, out=gate, mode="clip")
                np.matmul(state, h, out=spare)
                gate += spare
                np.tanh(gate, out=gate)
                gate *= 0.5
                gate += 0.5
            np.take(tables[2], codes[t], axis=0, out=fresh, mode="clip")
            np.matmul(state, square[2], out=spare)
            spare += self.c
            spare *= reset
            fresh += spare
            np.tanh(fresh, out=fresh)
            np.subtract(state, fresh, out=spare)
            spare *= update
            state = out[t]
            np.add(fresh, spare, out=state)
        return out

    def backward(self, codes: np.ndarray, kept: list, grads: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights given those of the states."""
        dx, dh, dc = np.zeros_like(self.x), np.zeros_like(self.h), np.zeros_like(self.c)
        carry = np.zeros_like(grads[0])
        for t in range(len(kept) - 1, -1, -1):
            state, gates, inner, fresh = kept[t]
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            d = grads[t] + carry
            d_fresh = d * (1 - update) * (1 - fresh * fresh)
            d_inner = d_fresh * reset
            d_gates = np.concatenate([d * (state - fresh), d_fresh * inner], axis=1) * (2 * gates * (1 - gates))
            d_pre = np.concatenate([d_gates, d_inner], axis=1)
            np.add.at(dx, codes[t], np.concatenate([d_gates, d_fresh], axis=1))
            dh += state.T @ d_pre
            dc += d_inner.sum(axis=0)
            carry = d * update + d_pre @ self.h.T
        return [dx, dh, dc]


class Model:
    def __init__(self, langs: list[str], seed: int = 9):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.ahead, self.back = ByteGru(rng), ByteGru(rng)
        self.out = rng.normal(0, 0.1, (2 * HIDDEN, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), dtype=np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.ahead.params(), *self.back.params(), self.out, self.bias]

    def _softmax(self, scores: np.ndarray) -> np.ndarray:
        scores += self.bias
        scores -= scores.max(axis=-1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=-1, keepdims=True)
        return scores

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """A distribution over languages for every position (steps, rows)."""
        ahead, back = self.ahead.states(codes), self.back.states(codes[::-1])[::-1]
        scores = ahead @ self.out[:HIDDEN]
        scores += back @ self.out[HIDDEN:]
        return self._softmax(scores)

    def step(self, codes: np.ndarray, lang: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all real positions."""
        kept_a: list = []
        kept_b: list = []
        states = np.concatenate([self.ahead.forward(codes, kept_a), self.back.forward(codes[::-1], kept_b)[::-1]], axis=2)
        grad = self._softmax(states @ self.out)
        grad[:, np.arange(codes.shape[1]), lang] -= 1
        grad *= ((codes != PAD) / max(1, int((codes != PAD).sum())))[:, :, None].astype(np.float32)
        d_states = grad @ self.out.T
        flat = grad.reshape(-1, len(self.langs))
        return [
            *self.ahead.backward(codes, kept_a, d_states[:, :, :HIDDEN]),
            *self.back.backward(codes[::-1], kept_b, d_states[::-1, :, HIDDEN:]),
            states.reshape(-1, 2 * HIDDEN).T @ flat,
            flat.sum(axis=0),
        ]

    def fit(self, chunks: np.ndarray, lang: np.ndarray, seed: int = 19) -> None:
        """Adam over ``UPDATES`` batches balanced over the languages."""
        rng = np.random.default_rng(seed)
        params = self.params()
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        by_lang = [np.flatnonzero(lang == k) for k in range(len(self.langs))]
        for turn in range(1, UPDATES + 1):
            pick = np.concatenate([rng.choice(own, max(1, BATCH // len(by_lang))) for own in by_lang])
            grads = self.step(chunks[:, pick], lang[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            rate = RATE * min(1.0, 1.2 * (1 - turn / (UPDATES + 1)))
            for p, g, m, v in zip(params, grads, first, second):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)


class Chunks:
    """Texts cut into chunks of ``STEPS`` bytes: ``owner`` is the text of each;
    ``codes`` builds the padded byte codes of a range of them."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray):
        self.raw = raw
        sizes = np.diff(starts)
        pieces = -(-sizes // STEPS)
        self.owner = np.repeat(np.arange(sizes.size), pieces)
        nth = np.arange(self.owner.size) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin = starts[self.owner] + nth * STEPS
        self.end = starts[self.owner + 1]

    def codes(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """``(steps, chunks)``."""
        index = self.begin[low:high, None] + np.arange(STEPS)
        real = index < self.end[low:high, None]
        codes = np.full(index.shape, PAD, dtype=np.intp)
        codes[real] = self.raw[index[real]]
        return np.ascontiguousarray(codes.T)


def pool(model: Model, column: pa.Array) -> np.ndarray:
    """The mean position distribution of each text (zeros for empty ones)."""
    raw, starts = byte_view(column)
    chunks = Chunks(raw, starts)
    total = np.zeros((len(starts) - 1, len(model.langs)))
    for low in range(0, chunks.owner.size, ROWS):
        codes = chunks.codes(low, low + ROWS)
        sums = np.einsum("trl,tr->rl", model.labels(codes), (codes != PAD).astype(np.float32))
        np.add.at(total, chunks.owner[low : low + ROWS], sums)
    return total / np.maximum(np.diff(starts), 1)[:, None]


def train(docs: DataFrame) -> Model | None:
    """Fit on the bounded sample; None if no document has a language."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).where(F.length("text") > 0)
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).collect()}
    if not counts:
        return None
    # hashes far beyond the rank wanted need no ranking
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 4 * DOCS_PER_LANG / n)]), F.col("lang"))
    room = F.greatest(F.length("text") - SNIPPET_CHARS, F.lit(0)) + 1
    pieces = [F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit(k)), room).cast("int") + 1, F.lit(SNIPPET_CHARS)) for k in range(SNIPPETS)]
    rank = Window.partitionBy("lang").orderBy("draw", "doc_id")
    sample = (
        rows.where(F.col("lang").isin(list(counts)))
        .withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / (1 << 31)).where(F.col("draw") < share)
        .select("doc_id", "lang", "draw", F.array(*pieces).alias("pieces"))
        .withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= DOCS_PER_LANG)
        .select("lang", "nth", F.explode("pieces").alias("piece")).orderBy("lang", "nth", "piece").toArrow()
    )
    langs = sorted(counts)
    number = {lang: k for k, lang in enumerate(langs)}
    chunks = Chunks(*byte_view(sample.column("piece")))
    lang = np.array([number[x] for x in sample.column("lang").to_pylist()])[chunks.owner]
    model = Model(langs)
    model.fit(chunks.codes(), lang)
    return model


def predict(docs: DataFrame, model: Model | None, whole: bool = False) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every text; with ``whole``, the rows of
    ``docs`` as they are and those two columns, without a shuffle."""
    reach_workers(docs.sparkSession)
    rows = docs if whole else texts(docs)
    back = rows.columns if whole else ["doc_id"]
    text, readable = rows.columns.index("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return rows.select(*back, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    named = T.StructType(rows.select(*back).schema.fields + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = pool(model, batch.column(text))
            readable = batch.columns[-1].to_numpy(zero_copy_only=False).astype(bool)
            best = shares.argmax(axis=1)
            names = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, readable)]
            score = np.where(readable, np.clip(shares.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(back)], pa.array(names, pa.string()), pa.array(score)], names=named.names)

    return rows.select("*", readable.alias("readable")).mapInArrow(run, named)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` and predict all of them."""
    return predict(docs, train(docs))
