"""Business questions over the purchase events."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MACHINE = "snack_automat_id"


def _now(df: DataFrame, now: Column | None) -> Column:
    return now if now is not None else df.agg(F.max("time_stamp").alias("t")).scalar()


def unprofitable_machines(df: DataFrame, threshold: float | Decimal) -> DataFrame:
    """Machines whose revenue is below ``threshold``."""
    return (
        df.groupBy(MACHINE)
        .agg(F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("sold"))
        .filter(F.col("revenue") < F.lit(threshold))
    )


def top_machines(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` machines with the most purchases, with customers and revenue."""
    return (
        df.groupBy(MACHINE)
        .agg(
            F.count(F.lit(1)).alias("sold"),
            F.count_distinct("customer_id").alias("customers"),
            F.sum("price").alias("revenue"),
        )
        .orderBy(F.desc("sold"), F.col(MACHINE))
        .limit(k)
    )


def healthy_share(df: DataFrame) -> DataFrame:
    """Count and revenue per health class, with the share of all purchases."""
    per_class = df.groupBy("healthy_food").agg(
        F.count(F.lit(1)).alias("sold"), F.sum("price").alias("revenue")
    )
    # One row for each class; their sum is the number of all purchases.
    total = F.sum("sold").over(Window.partitionBy(F.lit(0)))
    return per_class.withColumn("share", F.col("sold") / total)


def stockout_risk(df: DataFrame, capacity: int, window: str = "24 hours", now: Column | None = None) -> DataFrame:
    """Stock left per machine and item, and hours until empty at the recent rate.

    A slot starts with ``capacity`` articles; a slot with no recent sale has no end in sight.
    """
    since = _now(df, now) - F.expr(f"INTERVAL {window}")
    hours = F.expr(f"INTERVAL {window}").cast("interval second").cast("decimal(18,6)") / 3600
    recent = F.count(F.when(F.col("time_stamp") > since, F.lit(1)))
    return (
        df.groupBy(MACHINE, "item")
        .agg(F.count(F.lit(1)).alias("sold"), recent.alias("recent"))
        .withColumn("stock_left", F.greatest(F.lit(capacity) - F.col("sold"), F.lit(0)).cast("bigint"))
        .withColumn(
            "hours_left",
            F.when(F.col("recent") > 0, F.col("stock_left") * hours.cast("double") / F.col("recent")),
        )
    )


def gap_profile(df: DataFrame) -> DataFrame:
    """Per machine with two purchases or more: how many, first and last time, and the mean gap.

    The gaps of a machine add up to last minus first time, so the mean gap needs neither a sort
    nor a window.
    """
    last_us, first_us = F.unix_micros("last_seen"), F.unix_micros("first_seen")
    per_machine = df.filter(F.col("time_stamp").isNotNull()).groupBy(MACHINE).agg(
        F.min("time_stamp").alias("first_seen"), F.max("time_stamp").alias("last_seen"),
        F.count(F.lit(1)).alias("sold"),
    )
    return per_machine.filter(F.col("sold") > 1).withColumn("mean_gap_us", (last_us - first_us) / (F.col("sold") - 1))


def silent_machines(df: DataFrame, factor: float = 3.0, now: Column | None = None) -> DataFrame:
    """Machines silent for longer than ``factor`` times their mean gap between events."""
    return (
        gap_profile(df)
        .withColumn("silence_us", F.unix_micros(_now(df, now)) - F.unix_micros("last_seen"))
        .filter(F.col("silence_us") > F.lit(factor) * F.col("mean_gap_us"))
        .select(MACHINE, "sold", "last_seen", "mean_gap_us", "silence_us")
    )


def silence_alarms(events: DataFrame, profile: DataFrame, factor: float = 3.0, lateness: str = "0 seconds") -> DataFrame:
    """A row each time a machine has been silent for longer than ``factor`` times its mean gap; for streams.

    A machine's events form sessions, each held open for the machine's own gap after an event. A
    session that ends is a silence. On a stream, in append mode, the alarm comes when the watermark
    (the newest time of all machines, less ``lateness``; in milliseconds) passes its end, and the state
    holds the open sessions alone. ``profile`` is a static ``gap_profile``; machines it does not know have no gap yet.
    """
    known = profile.filter(F.col(MACHINE).isNotNull()).select(MACHINE, "mean_gap_us")
    # Longer than a number of microseconds is at least the next whole one.
    gap = F.concat((F.floor(F.lit(factor) * F.col("mean_gap_us")) + 1).cast("string"), F.lit(" microseconds"))
    timed = events.withWatermark("time_stamp", lateness).join(known, MACHINE)
    session = F.session_window("time_stamp", gap).alias("session")
    held = timed.groupBy(MACHINE, session).agg(F.max("time_stamp").alias("last_seen"), F.count(F.lit(1)).alias("sold"))
    return held.select(MACHINE, "last_seen", F.col("session.end").alias("alarm_at"), "sold")


def standing_alarms(alarms: DataFrame, profile: DataFrame, now: Column) -> DataFrame:
    """The alarms behind which nothing was sold any more, in the form of ``silent_machines``."""
    last = alarms.groupBy(MACHINE).agg(F.max("last_seen").alias("_alarm"))
    return (
        profile.join(last, MACHINE).filter(F.col("_alarm") == F.col("last_seen"))
        .withColumn("silence_us", F.unix_micros(now) - F.unix_micros("last_seen"))
        .select(MACHINE, "sold", "last_seen", "mean_gap_us", "silence_us")
    )
