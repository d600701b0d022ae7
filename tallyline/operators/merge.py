"""Current totals out of snapshot histories, and their comparison with the raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESET_BATCH = -1


def latest_snapshot(
    view: DataFrame, keys: Sequence[str] = ("item",), mode: str = "complete", epoch: int | None = None
) -> DataFrame:
    """Current count per key of a real-time view history.

    Only one epoch counts, by default the newest. Where ``keys`` leave out the unit of a view that has
    one, the counts of all units of a key are added up. In complete mode its newest micro-batch holds every key seen,
    and the zero rows of the reset stand in for the others, so two partitions are read. In
    update mode each key is taken from the last micro-batch that changed it.
    """
    chosen = F.lit(epoch) if epoch is not None else view.agg(F.max("epoch").alias("e")).scalar()
    current = view.filter(F.col("epoch") == chosen)
    if mode == "complete":
        last = current.agg(F.max("batch_id").alias("b")).scalar()
        current = current.filter((F.col("batch_id") == last) | (F.col("batch_id") == RESET_BATCH))
    return counts_of(current, keys)


def counts_of(current: DataFrame, keys: Sequence[str] = ("item",)) -> DataFrame:
    """Count per key out of snapshots of one epoch: of each key, and unit, the newest one."""
    own = [*keys, "unit"] if "unit" in current.columns and "unit" not in keys else list(keys)
    per_unit = current.groupBy(*own).agg(F.max_by("count", "batch_id").alias("count"))
    if own == list(keys):
        return per_unit
    return per_unit.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("count"))


def latest_by_time(
    view: DataFrame, keys: Sequence[str] = ("item",), ts: str = "time_stamp", count: str = "count"
) -> DataFrame:
    """Newest count per key of a plain ``(keys, count, time)`` history; ties take the larger count."""
    return view.groupBy(*keys).agg(F.max_by(count, F.struct(ts, count)).alias(count))


def without_units(rows: DataFrame, covered: DataFrame) -> DataFrame:
    """The rows of units that ``covered`` does not list; null equals null. Works on streams too."""
    listed = covered.select(F.col("unit").alias("_unit")).distinct()
    return rows.join(listed, F.col("unit").eqNullSafe(F.col("_unit")), "left_anti")


def serving_view(
    batch: DataFrame, realtime: DataFrame, covered: DataFrame, keys: Sequence[str] = ("item",)
) -> DataFrame:
    """Batch total plus the live counts of all units the batch run did not cover.

    ``batch`` has ``(keys, count)``, ``realtime`` ``(keys, unit, count)`` and ``covered`` the
    units of that batch run. A null unit is a unit like any other.
    """
    live = (
        without_units(realtime, covered)
        .groupBy(*keys).agg(F.sum("count").alias("real"))
    )
    done = batch.select(*keys, F.col("count").alias("batch"))
    merged = done.join(live, list(keys), "full").select(
        *keys, F.coalesce("batch", F.lit(0)).alias("batch"), F.coalesce("real", F.lit(0)).alias("real")
    )
    return merged.withColumn("total", F.col("batch") + F.col("real"))


def reconcile(served: DataFrame, truth: DataFrame, keys: Sequence[str] = ("item",)) -> DataFrame:
    """Served ``total`` against the count over the validation view, with their difference."""
    carried = [c for c in ("batch", "real") if c in served.columns]
    expected = truth.select(*keys, F.col("count").alias("truth"))
    both = served.withColumnRenamed("total", "served").join(expected, list(keys), "full")
    numbers = [*carried, "served", "truth"]
    return (
        both.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])
        .withColumn("diff", F.col("served") - F.col("truth"))
        .withColumn("ok", F.col("diff") == 0)
    )
