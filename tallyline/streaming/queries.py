"""The streaming queries: archive, validation view and live counts."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.decode import decode_rows
from tallyline.operators.counts import count_items
from tallyline.session import few_listing_tasks
from tallyline.sources.folders import is_local
from tallyline.streaming.history import point_to
from tallyline.streaming.release import UNIT_TIME, read_cuts, releasing

# Fixed value: the pace of the live view.
LIVE_TRIGGER = {"processingTime": "2 seconds"}
DRAIN = {"availableNow": True}
# A query that stays up, with a micro-batch as soon as there is something.
AT_ONCE = {"processingTime": "0 seconds"}
STATE_PARTITIONS = 8
LANE = "lane"
#: How streams write the files of their checkpoint, and the way through Hadoop's older interface.
FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
#: How long a file source keeps the parts of its log that a compaction holds once more; Spark's own value is 10 minutes.
LOG_DELAY = "spark.sql.streaming.fileSource.log.cleanupDelay"
LOG_KEPT = "10s"
_starting = threading.Lock()


def publish(
    events: DataFrame, location: str, fmt: str = "text", options: dict[str, str] | None = None, lanes: int | None = None,
    packed: bool = False,
) -> None:
    """Append ``(value, unit)`` payloads to a file topic, or ``value`` to Kafka.

    A unit has a folder of its own. With ``packed`` (for a ``fmt`` with columns) the rows lie in the files that the
    tasks write, with the unit beside each: where units are many and small, a folder for each costs far more than its
    rows, at every listing once more. ``read_events`` reads both alike.

    With ``lanes`` the units of a file topic are dealt over so many topics beside each other (``lane_of``), which
    queries can read at the same time.
    """
    if fmt == "kafka":
        events.select("value").write.format("kafka").options(**(options or {})).save()
        return
    few_listing_tasks(events.sparkSession)
    rows, folders = events.select("value", "unit"), ["unit"]
    if packed:
        if fmt == "text" or lanes is not None:
            raise ValueError("a packed topic has the unit as a column and no lanes")
        rows.write.mode("append").format(fmt).save(location)
        return
    if lanes is not None:
        rows, folders = rows.withColumn(LANE, F.pmod(F.xxhash64("unit"), F.lit(lanes))), [LANE, "unit"]
    rows.write.mode("append").partitionBy(*folders).format(fmt).save(location)


def lane_of(location: str, number: int) -> str:
    """Where ``publish`` puts the topic of one lane."""
    return f"{location}/{LANE}={number}"


def dealt(rows: DataFrame, spread: int | None) -> DataFrame:
    """Rows dealt so that a micro-batch writes at most ``spread`` files for a unit; None leaves them where they are.

    What one task has read of a unit stays together, so a unit that few tasks have read is in few files.
    """
    if spread is None:
        return rows
    salt = F.pmod(F.spark_partition_id(), F.lit(spread)) if spread > 1 else F.lit(0)
    return rows.withColumn("_salt", salt).repartition("unit", "_salt").drop("_salt")


def archive(
    payloads: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN, spread: int | None = None
) -> StreamingQuery:
    """Append every payload as a line of the archive, one folder per unit.

    The sink's commit log makes each micro-batch appear once; readers of the folder see only
    committed files. ``spread`` bounds the files per unit and micro-batch, for a shuffle of the lines;
    ``compact_archive`` brings closed units to files of full size.
    """
    return (
        dealt(payloads.select("value", "unit"), spread).writeStream.format("text").partitionBy("unit")
        .outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(path)
    )


def append_raw_view(
    payloads: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN, spread: int | None = None
) -> StreamingQuery:
    """Append every event, typed, to the validation view. Events without an id get a new one."""
    rows = decode_rows(payloads)
    rows = rows.withColumn("id", F.coalesce("id", F.uuid()))
    return (
        dealt(rows, spread).writeStream.format("parquet").partitionBy("unit").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
    )


def write_snapshot(
    path: str | None, epoch: int, fmt: str = "parquet", options: dict[str, str] | None = None,
    mode: str = "overwrite",
) -> Callable[[DataFrame, int], None]:
    """A micro-batch callback that adds the counts, stamped, to the view's history.

    With files each micro-batch owns the partition ``epoch=/batch_id=``; a repeated batch
    overwrites it, so a retry leaves no second copy. When the rows are there, the pointer of the view
    is moved to the batch. ``mode="append"`` is for stores reached
    through a connector; ``id`` is made from epoch, batch and key there, so that a retry writes
    the same rows again and a store keyed by ``id`` keeps one. Errors go up and stop the query:
    the batch is then run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keys = [c for c in batch.columns if c != "count"]
        mark = F.to_json(F.struct(F.lit(epoch).alias("epoch"), F.lit(batch_id).alias("batch"), *keys))
        stamped = batch.withColumns({
            "time_stamp": F.current_timestamp(),
            "id": F.sha2(mark, 256) if mode == "append" else F.uuid(),
            "epoch": F.lit(epoch).cast("bigint"),
            "batch_id": F.lit(batch_id).cast("bigint"),
        })
        writer = stamped.write.format(fmt).options(**(options or {})).mode(mode)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "batch_id")
        writer.save(path)
        if mode == "overwrite":
            point_to(batch.sparkSession, path, epoch, batch_id)

    return write


def snapshot_stream(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("item",),
    epoch: int = 0,
    trigger: dict = LIVE_TRIGGER,
    mode: str = "complete",
    callback: Callable[[DataFrame, int], None] | None = None,
    state_partitions: int = STATE_PARTITIONS,
    cuts: str | None = None,
) -> StreamingQuery:
    """Running count per key with one snapshot per micro-batch.

    ``mode="complete"`` writes every key each time; with many keys ``"update"`` writes only
    those that changed. The shuffle carries one row per task and key, so it follows the number
    of keys and not the volume of events; ``state_partitions`` is fixed for a checkpoint's life.

    With ``cuts``, the folder of published cuts (``publish_cut``), the state of units that a published
    run covers is let go. ``keys`` must have the unit and ``mode`` must be ``"update"``: the snapshots
    of those units stay in the history, and are covered.
    """
    events = payloads
    if "value" in payloads.columns:
        events = decode_rows(payloads, fields=["item"])
    if cuts is None:
        counts = count_items(events, keys)
    else:
        if mode != "update" or "unit" not in keys:
            raise ValueError("state is let go by unit, in update mode")
        events = releasing(events.select(*keys), read_cuts(events.sparkSession, cuts))
        counts = count_items(events, [*keys, UNIT_TIME]).drop(UNIT_TIME)
    writer = (
        counts.writeStream.outputMode(mode)
        .foreachBatch(callback or write_snapshot(path, epoch))
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    )
    conf = payloads.sparkSession.conf
    # A query takes over the session's settings when it starts, so starts go one by one.
    with _starting:
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def small_batches(spark: SparkSession, checkpoints: str) -> Iterator[None]:
    """Streams started within cost the driver less for each micro-batch: for many small ones without a shuffle.

    A micro-batch writes three files below ``checkpoints``. On a local disk Spark's own way starts eight
    processes to rename each, which the older interface of the file system does not; what is written, and when,
    is the same. Other stores, and a way that is set, are left alone. Plans are neither adapted nor described at
    length, as each runs once and has one stage. The log of files read is listed in each micro-batch, so what
    its compaction has taken over stays ``LOG_KEPT`` only.
    """
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.ui.explainMode": "simple", LOG_DELAY: LOG_KEPT}
    with _starting:
        if spark.conf.get(FILE_MANAGER, None) is None and is_local(spark, checkpoints):
            wanted[FILE_MANAGER] = BY_FILE_SYSTEM
        before = {key: spark.conf.get(key, None) for key in wanted}
        try:
            for key, value in wanted.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def run_until_ok(
    start: Callable[[], StreamingQuery], retries: int = 3, wait_s: float = 5.0
) -> StreamingQuery:
    """Start a query and wait for it; after a failure start it again from its checkpoint."""
    for attempt in range(retries + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            query.stop()
            if attempt == retries:
                raise
            time.sleep(wait_s)
    raise AssertionError("unreachable")


def replay(
    payloads: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = ("item",), epoch: int = 0
) -> StreamingQuery:
    """Rebuild the live view from the whole log: a new checkpoint, read from the start to the end."""
    return snapshot_stream(payloads, path, checkpoint, keys, epoch, DRAIN)


def batch_sizes(payloads: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Store ``(batch_id, rows)`` of every micro-batch; a repeated batch replaces its own row."""

    def count(batch: DataFrame, batch_id: int) -> None:
        rows = batch.agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return payloads.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(**trigger).start()
