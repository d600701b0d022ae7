"""Letting go of live state that a published batch run covers.

State per item and ingestion unit grows with the log. Units that a run covers are closed and counted
elsewhere, so their state can go, but not before the run is published. Units are given a time in
their order, and the stream of events is unioned with the stream of published cuts, each with a
watermark. The query's watermark is the lower of the two, so it never passes the newest published
cut, and Spark evicts the state up to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources.folders import ensure_folder
from tallyline.sources.topics import source_of

UNIT_TIME = "_unit_time"
CUTS = T.StructType([T.StructField("cut", T.TimestampType()), T.StructField("run_id", T.LongType())])


def unit_time(unit: str | Column = "unit") -> Column:
    """A time in the order of the units: their number, the digits at the end, as seconds. Null if there is none.

    A query's watermark begins at 0, and what is not above it is late, so the first unit has 1.
    """
    unit = F.col(unit) if isinstance(unit, str) else unit
    number = F.nullif(F.regexp_extract(unit, r"(\d+)$", 1), F.lit(""))
    return F.timestamp_seconds(number.cast("bigint") + 1)


def cut_of(units: DataFrame) -> DataFrame:
    """The cut (``cut``, one row or none) up to which all units are among ``units``.

    A run covers the closed units of each source from the first one on. Where sources have come to
    different numbers, the lowest one counts. A run without numbered units gives no cut.
    """
    numbers = units.select(source_of("unit").alias("source"), unit_time().alias("t"))
    per_source = numbers.groupBy("source").agg(F.max("t").alias("t"))
    return per_source.agg(F.min("t").alias("cut")).filter("cut IS NOT NULL")


def read_cuts(spark: SparkSession, cuts: str) -> DataFrame:
    """The published cuts as a stream; there need not be one yet."""
    ensure_folder(spark, cuts)
    return spark.readStream.schema(CUTS).parquet(cuts)


def releasing(events: DataFrame, cuts: DataFrame) -> DataFrame:
    """Events (``item``, ``unit``) with the watermark of the published cuts, for a count by item, unit and ``UNIT_TIME``.

    Events of units up to a cut that come after it are not counted: those units are closed, and
    served totals leave them out. Events without a numbered unit have no time and are kept.
    """
    timed = events.withColumn(UNIT_TIME, unit_time()).withWatermark(UNIT_TIME, "0 seconds")
    # A cut is a row without an item, which no count takes in.
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields]
    marks = cuts.select(*empty, F.col("cut").alias(UNIT_TIME)).withWatermark(UNIT_TIME, "0 seconds")
    return timed.unionByName(marks)
