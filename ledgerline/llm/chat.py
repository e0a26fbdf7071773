"""Chat formatting with typed content parts (operator 7).

A turn's content is an ordered array of parts (``type`` text, image, audio or
document, ``text``, ``ref`` and ``units``); a plain text is one text part. A
visitor over the parts writes texts escaped and every attachment as a numbered
placeholder, records its reference and counts its expanded tokens (``units``
times the price of its type).

    <|begin|>  { <|turn|> role <|says|> content <|stop|> }  <|end|>

``&``, ``<`` and ``[`` in roles and texts are written as entities, so no text
can contain a mark or a placeholder, whatever control strings it quotes, and
reading back undoes it exactly. The loss mask holds the code-point spans of
assistant content, without marks.

Everything is DataFrame expressions. A conversation is one output string, so
its turns meet in one row; nothing else does. Turns are ordered by ``turn``
(ties: role, then text); repeated rows are turns of their own. A null text or
role is empty; null ids form one conversation. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, TURN, SAYS, STOP, END = "<|begin|>", "<|turn|>", "<|says|>", "<|stop|>", "<|end|>"
LEARNED = "assistant"
# Tokens per unit: a tile of an image, a second of audio, a page of a document.
PRICES = {"image": 256, "audio": 25, "document": 640}
TEXT_CHARS_PER_TOKEN = 4
PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit("["), F.lit("&#91;"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("&#91;"), F.lit("["))
    out = F.replace(out, F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def text_part(text: Column) -> Column:
    none = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("units"))
    return F.array(part).cast(PARTS)


def _content(parts: Column) -> Column:
    """The visitor: parts in order, attachments as placeholders."""

    def visit(part: Column, k: Column) -> Column:
        holder = F.concat(F.lit("["), part["type"], F.lit(":"), k.cast("string"), F.lit("]"))
        return F.when(part["type"].isin(*PRICES), holder).otherwise(escape(F.coalesce(part["text"], F.lit(""))))

    return F.array_join(F.transform(parts, visit), "")


def _tokens(parts: Column) -> Column:
    def price(part: Column) -> Column:
        out = F.ceil(F.length(F.coalesce(part["text"], F.lit(""))) / TEXT_CHARS_PER_TOKEN)
        for kind, each in PRICES.items():
            out = F.when(part["type"] == kind, F.coalesce(part["units"], F.lit(1)).cast("long") * each).otherwise(out)
        return out

    return F.aggregate(F.transform(parts, price), F.lit(0).cast("long"), lambda a, b: a + b)


def _attachments(parts: Column, turn: Column) -> Column:
    tagged = F.transform(parts, lambda p, k: F.struct(turn.alias("turn"), k.alias("part"), p["type"].alias("type"), p["ref"].alias("ref")))
    return F.filter(tagged, lambda p: p["type"].isin(*PRICES))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_spans, attachments, n_tokens)``.

    ``turns``: ``conv_id, turn, role, text`` and optionally ``parts``.
    ``loss_spans``: code-point ``start`` and ``stop`` (exclusive)."""
    parts = F.col("parts").cast(PARTS) if "parts" in turns.columns else text_part(F.col("text"))
    parts = F.coalesce(parts, text_part(F.col("text")))
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), parts.alias("parts"), F.coalesce(F.col("text"), F.lit("")).alias("plain"),
    )
    said = said.select("conv_id", "turn", "role", "plain", _content(F.col("parts")).alias("body"), _tokens(F.col("parts")).alias("tokens"), _attachments(F.col("parts"), F.col("turn")).alias("files"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS))
    said = said.withColumn("head", head)
    packed = F.struct("turn", "role", "plain", "body", "head", "tokens", "files")  # ties: role and text as they are, then parts
    convs = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(packed)).alias("turns"))
    turn_text = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(STOP)))
    sizes = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(STOP))

    def grow(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["head"])
        stop = start + F.length(t["body"])
        own = F.when(t["role"] == LEARNED, F.array(F.struct(start.alias("start"), stop.alias("stop")))).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))
        return F.struct((stop + len(STOP)).alias("at"), F.concat(acc["spans"], own).alias("spans"))

    first = F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))
    return convs.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.concat(F.lit(BEGIN), F.array_join(turn_text, ""), F.lit(END)).alias("formatted"),
        F.aggregate("turns", first, grow)["spans"].alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["files"])).alias("attachments"),
        F.aggregate(F.transform("turns", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens"),
        F.aggregate(sizes, F.lit(len(BEGIN) + len(END)), lambda a, b: a + b).alias("n_chars"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as ``role`` and ``text`` (with
    placeholders where attachments stood)."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN) - len(END))
    pieces = F.filter(F.split(body, r"<\|stop\|>"), lambda x: x != "")

    def parse(piece: Column) -> Column:
        cut = F.split(F.substring(piece, F.lit(len(TURN) + 1), F.length(piece)), r"<\|says\|>")
        return F.struct(unescape(cut[0]).alias("role"), unescape(cut[1]).alias("text"))

    return F.transform(pieces, parse)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing in between."""
    cut = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["stop"] - s["start"])))
    return F.array_join(cut, "")
