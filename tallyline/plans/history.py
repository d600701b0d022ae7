"""Snapshot histories derived from the events: what a view showed at the end of each period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.ordered import MAX_GROUP_ROWS, ordered_scan, running_sum

LONG_PERIODS = ("hour", "day", "week", "month", "quarter", "year")


def period_counts(events: DataFrame, every: str = "hour") -> DataFrame:
    """Events per item and period, stamped with the end of the period."""
    begin = F.date_trunc(every, "time_stamp")
    counts = events.groupBy("item", begin.alias("_begin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("item", "count", (F.col("_begin") + F.expr(f"INTERVAL 1 {every}")).alias("time_stamp"))


def snapshot_history(events: DataFrame, every: str = "hour") -> DataFrame:
    """Total per item at the end of each period with events.

    Only the counts per period are put in order. By the hour or more that is at most 8,784 rows
    per item and year, and the size check of the ordered scan is left out.
    """
    limit = None if every in LONG_PERIODS else MAX_GROUP_ROWS
    totals = ordered_scan(
        period_counts(events, every), ["item"], ["time_stamp"], limit, total=running_sum(F.col("count"))
    )
    return totals.select("item", F.col("total").alias("count"), "time_stamp")
