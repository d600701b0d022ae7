"""The headline question: how many articles of each type were sold in total?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.functions.decode import usable_item
from tallyline.operators.counts import count_by
from tallyline.operators.merge import latest_snapshot
from tallyline.schema import REALTIME_VIEW
from tallyline.session import work_dir
from tallyline.sources.views import read_view
from tallyline.streaming.queries import DRAIN, snapshot_stream


def items_sold(events: DataFrame) -> DataFrame:
    """From typed events, in one scan of one column."""
    return count_by(events.filter(usable_item()))


def items_sold_live(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    """From a stream of payloads, drained to its present end."""
    work = work_dir(spark, "live")
    snapshot_stream(payloads, f"{work}/view", f"{work}/checkpoint", trigger=DRAIN).awaitTermination()
    return latest_snapshot(read_view(spark, f"{work}/view", REALTIME_VIEW))
