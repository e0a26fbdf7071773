"""What each micro-batch did, as Spark reports it.

``counted`` puts an ``observe`` into the stream's own plan, so rows are counted in
the pass that writes them; ``FlushProgress`` is a listener that keeps one record
per micro-batch: the records read, the observed counts and, with a
``Maintenance``, its failures so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerline.constants import DELETE_OPS, IH_OP, UPSERT_OPS

METRICS = "ll_flush"


def counted(stream: DataFrame, op_col: str = IH_OP) -> DataFrame:
    """The stream, counting its rows, upserts and deletes on the way. For
    sinks that evaluate a micro-batch once (any but ``foreachBatch``)."""
    op = F.col(op_col)
    return stream.observe(
        METRICS, F.count(F.lit(1)).alias("rows"), F.count_if(op.isin(*UPSERT_OPS)).alias("upserts"), F.count_if(op.isin(*DELETE_OPS)).alias("deletes"))


class FlushProgress(StreamingQueryListener):
    """Records of the micro-batches of the query named ``query_name``."""

    def __init__(self, query_name: str, upkeep=None):
        self.query_name = query_name
        self.upkeep = upkeep
        self.batches: dict[int, dict] = {}

    def onQueryStarted(self, event) -> None:
        return None

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.query_name or not progress.numInputRows:
            return
        seen = progress.observedMetrics.get(METRICS)
        counts = {k: (seen[k] if seen is not None else None) for k in ("rows", "upserts", "deletes")}
        failures = self.upkeep.failures if self.upkeep is not None else 0
        self.batches[progress.batchId] = {"records": progress.numInputRows} | counts | {"failures": failures}

    def onQueryIdle(self, event) -> None:
        return None

    def onQueryTerminated(self, event) -> None:
        return None


__all__ = ["FlushProgress", "METRICS", "counted"]
