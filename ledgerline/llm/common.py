"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import work_dir
from ledgerline.sinks import fs


BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (on a
    cluster that ships it otherwise, the path is simply not there), and send
    them whole texts in batches of ``BATCH_ROWS`` unless the session says
    otherwise: a batch is held several times over on its way."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    if spark.conf.get(_BATCH) == "10000":  # Spark's default
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (a null text is empty); whatever else the
    table carries cannot clash with an operator's columns."""
    reach_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


class Scratch:
    """Tables an operator writes to cut lineage, under the shared checkpoint
    folder, so a lost executor never costs more than one step. ``drop`` frees
    a table no later step reads; what a returned DataFrame still reads goes,
    with its folder, when the session's driver ends (``work_dir``)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = work_dir(spark, name)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.root}/{label}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            fs.delete(self.spark, f"{self.root}/{label}")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream of batches that is sorted by ``keys``, one at a
    time: only the group at hand is in memory, however long the stream."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        values = list(zip(*columns))
        cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
        for low, high in zip([0, *cuts], [*cuts, len(values)]):
            if held and values[low] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = values[low]
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``(id, component)`` for every id on an edge ``(a, b)``; the component is
    its smallest id.

    Each round joins every vertex to its smallest neighbour and contracts the
    edges, as aggregates with a partial minimum and equi-joins; a round's
    tables are written before the next one reads them. Stars and forests, as
    the callers emit, take a few rounds whatever their size.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.keep(edges, f"{label}-edges-0")
    labels, turn = None, 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        step = both.groupBy("id").agg(F.min("other").alias("least")).select("id", F.least("id", "least").alias("to"))
        step = scratch.keep(step, f"{label}-step-{turn}")
        left = step.select(F.col("id").alias("a"), F.col("to").alias("to_a"))
        right = step.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(left, "a").join(right, "b").where("to_a <> to_b")
        moved = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        if labels is None:
            renamed = step.select("id", F.col("to").alias("component"))
        else:
            hop = step.select(F.col("id").alias("component"), "to")
            renamed = labels.join(hop, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        edges, labels = scratch.keep(moved, f"{label}-edges-{turn + 1}"), scratch.keep(renamed, f"{label}-labels-{turn + 1}")
        scratch.drop(f"{label}-edges-{turn}", f"{label}-labels-{turn}", f"{label}-step-{turn}")
        turn += 1
    scratch.drop(f"{label}-edges-{turn}")
    if labels is None:
        return scratch.spark.createDataFrame([], "id long, component long")
    return labels
