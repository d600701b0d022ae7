"""Restart messages between the batch layer and the speed layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.schema import CONTROL, EPOCH_TABLE
from tallyline.sources.views import read_view

# Fixed value: what a restart message says.
RESTART = "True"


def encode_restart(runs: DataFrame) -> DataFrame:
    """One restart message per row with a ``run_id``."""
    return runs.select(F.to_json(F.struct(F.lit(RESTART).alias("restart"), "run_id")).alias("value"))


def emit_restart(spark: SparkSession, topic: str, run_id: int | None = None) -> None:
    """Ask for a restart, behind the run named or, without one, behind the newest published run."""
    runs = spark.range(1).select(F.lit(run_id).cast("bigint").alias("run_id"))
    encode_restart(runs).write.mode("append").text(topic)


def restart_signals(messages: DataFrame) -> DataFrame:
    """One row per message that asks for a restart, with the run it names or null; all else is passed over."""
    parsed = messages.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), CONTROL))))
    return parsed.filter(F.col("restart") == RESTART).select("run_id")


def on_restart(
    messages: DataFrame, act: Callable[[int | None], None], checkpoint: str, trigger: dict,
    epoch_table: str | None = None,
) -> StreamingQuery:
    """Call ``act`` with a run each time the control topic asks for a restart.

    It is the newest run that the messages name; where they name none, the newest one published in
    ``epoch_table``, or None if there is no such table or run.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        asked = batch.agg(F.count(F.lit(1)).alias("n"), F.max("run_id").alias("r")).first()
        if not asked["n"]:
            return
        run_id = asked["r"]
        if run_id is None and epoch_table:
            published = read_view(batch.sparkSession, epoch_table, EPOCH_TABLE)
            run_id = published.agg(F.max("run_id").alias("r")).first()["r"]
        act(run_id)

    return (
        restart_signals(messages).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
