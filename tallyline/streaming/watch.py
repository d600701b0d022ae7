"""What a running query does per micro-batch, taken from its progress reports.

Counts and other metrics are observed on the way of the rows, so no job is added and nothing is
written beside the query's own output.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

METRICS = "batch"
# Reports that a query holds while it is watched.
KEPT = 1_000_000
_KEEP = "spark.sql.streaming.numRecentProgressUpdates"


def observed(rows: DataFrame, **metrics: Column) -> DataFrame:
    """The same rows, counted on their way; further ``metrics`` are aggregates of their columns."""
    return rows.observe(METRICS, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in metrics.items()])


class BatchWatch:
    """Has the session's ``observed`` queries keep what each micro-batch reports, and hands it over: a dict per batch.

    Use as a context around the starts of the queries, or ``attach`` and ``detach``. A query holds its
    own last ``kept`` reports, a few kilobytes each, and they are read once, at its end. A listener
    in Python takes about 0.1 s for each report, more than many a micro-batch takes.
    """

    def __init__(self, spark: SparkSession, kept: int = KEPT):
        self.spark, self.kept, self._before, self._taken = spark, kept, None, set()

    def attach(self) -> "BatchWatch":
        self._before = self.spark.conf.get(_KEEP)
        # Spark keeps one less than it is told.
        self.spark.conf.set(_KEEP, str(self.kept + 1))
        return self

    def detach(self) -> None:
        self.spark.conf.set(_KEEP, self._before)

    __enter__ = attach

    def __exit__(self, *raised) -> None:
        self.detach()

    def take(self, query: StreamingQuery, wait_s: float = 60.0) -> list[dict]:
        """The micro-batches of a query that has ended, once; reports that no longer were kept are an error."""
        try:
            if not query.awaitTermination(wait_s):
                raise TimeoutError("the query has not ended")
        except StreamingQueryException:
            pass  # the batches before the failure are there
        if query.runId in self._taken:
            return []
        reports = query.recentProgress
        if len(reports) >= self.kept:
            raise RuntimeError(f"the query has made more than the {self.kept} reports that are kept")
        self._taken.add(query.runId)
        seen = {}
        for progress in reports:
            found = progress.observedMetrics.get(METRICS)
            if found is not None:
                ms = progress.durationMs.get("triggerExecution")
                seen[progress.batchId] = {"batch_id": progress.batchId, "trigger_ms": ms, **found.asDict()}
        return [batch for _, batch in sorted(seen.items())]
