"""The ``events`` table read as purchases, in one go or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.encode import machine_name
from tallyline.schema import MONEY

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
# Events of one ingestion unit. Event numbers follow the order of arrival.
EVENTS_PER_UNIT = 500
# Event types taken as healthy food; an arbitrary but fixed class of this adapter.
HEALTHY_TYPES = ("purchase", "view")
# Fixed value: ``props`` is always {"k": number}; a pattern finds it in a quarter of the time that
# parsing the JSON takes.
MACHINE_NUMBER = r'"k":\s*(\d+)'


def _as_purchases(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("item"),
        F.col("user_id").alias("customer_id"),
        F.when(F.col("event_type").isin(*HEALTHY_TYPES), F.lit("healthy"))
        .otherwise(F.lit("not_healthy")).alias("healthy_food"),
        F.col("value").cast(MONEY).alias("price"),
        machine_name(F.nullif(F.regexp_extract("props", MACHINE_NUMBER, 1), F.lit(""))).alias("snack_automat_id"),
        F.col("ts").cast("timestamp").alias("time_stamp"),
        F.lpad(F.expr(f"CAST(event_id DIV {EVENTS_PER_UNIT} AS STRING)"), 12, "0").alias("unit"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the whole table; ``unit`` is the run of event numbers in which the event was taken in."""
    return _as_purchases(spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet"))


def stream_purchases(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same rows as a stream over the table's files."""
    # A stream over files needs a folder or a pattern, not the path of one file.
    return _as_purchases(
        spark.readStream.schema(EVENTS_DDL)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{sf_dir}/event[s].parquet")
    )
