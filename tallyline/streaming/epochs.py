"""The hand-off between batch and live counts.

A published batch run lists the ingestion units it covers. Readers add the live counts of all
other units, so a unit is counted once, whenever the run is published. When the live state has
grown, a new epoch starts behind the published units with zero counts. Readers stay with the old
epoch until the new one has caught up and is made the active one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.merge import RESET_BATCH, without_units
from tallyline.schema import ACTIVE_EPOCHS, EPOCH_TABLE, REALTIME_VIEW
from tallyline.sources.views import ensure_view, read_view
from tallyline.streaming.history import current_snapshot, known_epochs
from tallyline.streaming.queries import write_snapshot
from tallyline.streaming.release import cut_of


def write_run(rows: DataFrame, path: str, run_id: int) -> None:
    """Write the rows as the folder of one run. An earlier try is replaced, also by no rows at all."""
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def active_table(realtime: str) -> str:
    """Where the active epochs of a live view are kept unless said otherwise."""
    return f"{realtime}_active"


def publish_run(units: DataFrame, epoch_table: str, run_id: int) -> None:
    """List the units of a finished run. Done last, and safe to repeat."""
    write_run(units.select("unit").distinct().withColumn("published_at", F.current_timestamp()), epoch_table, run_id)


def covered_units(spark: SparkSession, epoch_table: str, run_id: int | None = None) -> DataFrame:
    """Units of one run, by default of the newest published one."""
    table = read_view(spark, epoch_table, EPOCH_TABLE)
    wanted = F.lit(run_id) if run_id is not None else table.agg(F.max("run_id").alias("r")).scalar()
    return table.filter(F.col("run_id") == wanted)


def publish_cut(spark: SparkSession, epoch_table: str, cuts: str, run_id: int) -> None:
    """Tell live queries up to which unit a published run covers all. Done behind ``publish_run``; safe to repeat."""
    write_run(cut_of(covered_units(spark, epoch_table, run_id)), cuts, run_id)


def newest_epoch(spark: SparkSession, realtime: str) -> int:
    known = known_epochs(spark, realtime)
    if known:
        return known[-1]
    row = read_view(spark, realtime, REALTIME_VIEW).agg(F.max("epoch").alias("e")).first()
    return 0 if row["e"] is None else row["e"]


def reset_counts(spark: SparkSession, realtime: str, epoch: int, keys: Sequence[str] = ("item",)) -> None:
    """Open an epoch with a zero row for each key the view knows."""
    known = current_snapshot(spark, realtime, keys).select(*keys).distinct()
    zeros = known.withColumn("count", F.lit(0).cast("bigint"))
    for name in ("item", "unit"):
        if name not in zeros.columns:
            zeros = zeros.withColumn(name, F.lit(None).cast("string"))
    write_snapshot(realtime, epoch)(zeros, RESET_BATCH)


def rotate_epoch(spark: SparkSession, realtime: str, keys: Sequence[str] = ("item",)) -> int:
    """Start the next epoch at zero and return its number.

    The caller stops the old query first and starts the new one on a new checkpoint, over the
    units not covered by the published run (``uncovered``).
    """
    epoch = newest_epoch(spark, realtime) + 1
    reset_counts(spark, realtime, epoch, keys)
    return epoch


def uncovered(payloads: DataFrame, covered: DataFrame) -> DataFrame:
    """Payloads of units a published run does not cover; works on streams too."""
    return without_units(payloads, covered)


def restart_behind_run(
    query: StreamingQuery, start: Callable[[int], StreamingQuery], realtime: str, keys: Sequence[str] = ("item",)
) -> StreamingQuery:
    """Stop the live query, set its counts to zero and start it afresh as the next epoch."""
    spark = SparkSession.active()
    query.stop()
    query.awaitTermination()
    return start(rotate_epoch(spark, realtime, keys))


def activate_epoch(spark: SparkSession, active: str, epoch: int) -> None:
    """Make readers use ``epoch`` from now on; an earlier epoch may be made active again."""
    row = spark.range(epoch, epoch + 1).select(F.current_timestamp().alias("activated_at"), F.col("id").alias("epoch"))
    row.write.mode("append").partitionBy("epoch").parquet(active)


def active_epoch(spark: SparkSession, active: str, realtime: str | None = None) -> int:
    """The epoch that was made active last; before the first time, the oldest one of the live view."""
    found = ensure_view(spark, active, ACTIVE_EPOCHS, ("epoch",))
    row = found.agg(F.max_by("epoch", "activated_at").alias("e")).first()
    if row["e"] is None and realtime is not None and (known := known_epochs(spark, realtime)):
        return known[0]
    if row["e"] is None and realtime is not None:
        row = read_view(spark, realtime, REALTIME_VIEW).agg(F.min("epoch").alias("e")).first()
    return 0 if row["e"] is None else row["e"]
