"""License scan by diagonal voting (operator 6).

All rolling word k-grams of every text are hashed and equi-joined to the
k-grams of the templates (a fixed table, broadcast). A hit at word ``p`` of a
text and word ``q`` of a template votes for the diagonal ``p - q``: a verbatim
copy puts all its votes on one diagonal, an insertion or deletion moves the
rest to a neighbouring one. Votes are aggregated by diagonal, diagonals of a
notice that lie within ``SLACK`` are merged, and a span is verified on the
words themselves: the share of the template's words that stand where the
diagonals say, at least ``COVER`` for notices of ``LONG`` words or more, and
all of them for shorter notices (which differ from each other in a word) and
for the three base phrases, whose diagonals are never merged.

Words are runs of letters, digits and non-ASCII characters of the lower-cased
text. A null or empty text has no words, no places, empty labels and score 0.
Repeated rows get equal rows; an empty table gives none. Only DataFrame
functions are used, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLACK, COVER, LONG = 3, 0.8, 12
# The base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Notices as their publishers word them.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international", "cc-by-sa"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)
GRAMS = (2, 3)


def words_of(text: F.Column) -> F.Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _grams(df: DataFrame, *keep: str) -> DataFrame:
    """A row per position and gram size of ``words``: ``pos, k, gram``."""
    spots = df.select(*keep, "words", F.posexplode("words").alias("pos", "word"))
    grams = [
        F.when(F.col("pos") + k <= F.size("words"), F.struct(F.lit(k).alias("k"), F.xxhash64(F.lit(k), *[F.get("words", F.col("pos") + j) for j in range(k)]).alias("gram")))
        for k in GRAMS
    ]
    return spots.select(*keep, "words", "pos", F.explode(F.array(*grams)).alias("g")).where("g is not null").select(*keep, "words", "pos", "g.k", "g.gram")


def templates(spark: SparkSession) -> DataFrame:
    rows = [(k, text.split(), label, k < len(PHRASES)) for k, (text, label) in enumerate([*PHRASES, *NOTICES])]
    df = spark.createDataFrame(rows, "template int, words array<string>, label string, exact boolean")
    grams = _grams(df, "template", "label", "exact").where(F.col("k") == F.least(F.size("words"), F.lit(max(GRAMS))))
    return grams.select("template", "label", "exact", F.col("words").alias("wanted"), F.col("pos").alias("at"), "k", "gram")


def license_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Verified spans: ``doc_id, text_hash, label, exact, first, last, cover``
    (word positions, inclusive)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    hits = _grams(texts, "doc_id", "text_hash").join(F.broadcast(templates(spark)), ["k", "gram"])
    hits = hits.withColumn("diagonal", F.col("pos") - F.col("at"))
    # A stage of generated code hands on all rows of a text together, so a hit must not carry the
    # text's words out of it: the few that the template covers are cut out in the stage of the join.
    # (No expression of the partition's number is moved, so the cut stays where it is.)
    begin = F.greatest(F.col("diagonal"), F.lit(0))
    cut = F.slice("words", begin + 1, F.size("wanted") + F.col("diagonal") - begin)
    hits = hits.select("doc_id", "text_hash", "template", "label", "exact", "diagonal", "wanted", F.when(F.spark_partition_id() >= 0, cut).alias("near"))
    ahead = F.col("diagonal") - F.greatest(F.col("diagonal"), F.lit(0))
    standing = F.filter(F.sequence(F.lit(0), F.size("wanted") - 1), lambda j: F.get("near", ahead + j) == F.get("wanted", j))
    votes = hits.select("doc_id", "text_hash", "template", "label", "exact", "diagonal", F.size("wanted").alias("length"), standing.alias("standing"))
    diagonals = votes.groupBy("doc_id", "text_hash", "template", "diagonal").agg(
        F.first("label").alias("label"), F.first("exact").alias("exact"), F.first("length").alias("length"), F.first("standing").alias("standing"), F.count("*").alias("votes")
    )
    order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    diagonals = diagonals.withColumn("new", F.when(apart.isNull() | F.col("exact") | (apart > SLACK), 1).otherwise(0))
    diagonals = diagonals.withColumn("span", F.sum("new").over(order))
    merged = diagonals.groupBy("doc_id", "text_hash", "template", "span").agg(
        F.first("label").alias("label"), F.first("exact").alias("exact"), F.first("length").alias("length"), F.sum("votes").alias("votes"),
        F.min(F.col("diagonal") + F.array_min("standing")).alias("first"), F.max(F.col("diagonal") + F.array_max("standing")).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("standing")))).alias("stand"),
    )
    cover = F.col("stand") / F.col("length")
    fits = F.col("last") - F.col("first") < F.col("length") + 2 * SLACK
    least = F.when(F.col("exact") | (F.col("length") < LONG), F.lit(1.0)).otherwise(F.lit(COVER))
    return merged.withColumn("cover", cover).where((cover >= least) & fits).select(
        "doc_id", "text_hash", "label", "exact", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "cover"
    )


def scan_licenses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: places, labels and the best cover."""
    spans = license_spans(spark, docs)
    start = F.when(F.col("exact"), F.col("first"))
    per_doc = spans.groupBy("doc_id", "text_hash").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("cover").alias("score"),
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    same = texts["doc_id"].eqNullSafe(per_doc["doc_id"]) & (texts["text_hash"] == per_doc["text_hash"])
    return texts.join(per_doc, same, "left").select(
        texts["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
