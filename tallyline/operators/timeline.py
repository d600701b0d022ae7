"""Timelines: running totals, ties, gaps, slices, interval sums, delays and their union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.time import micros_of, millis_interval
from tallyline.operators.ordered import (
    MAX_GROUP_ROWS, NO_TIME, following, last_known, ordered_scan, period_of, position, previous, running_sum,
)
from tallyline.session import stored

# Bounds of the broadcast form of ``interval_sum``.
MAX_BROADCAST_INTERVALS = 100_000
MAX_BROADCAST_BINS = 500_000
MAX_INTERVALS_PER_BIN = 8


def running_total(
    df: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    tie: str = "id",
    weight: Column | int = 1,
    out: str = "cumulated",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Total of ``weight`` up to each row, per key, in time order."""
    return ordered_scan(df, keys, [ts, tie], max_group_rows, **{out: running_sum(weight)})


def tie_rank(
    df: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    tie: str = "id",
    out: str = "tie_rank",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """0-based place of a row among the rows of its key with the same time."""
    return ordered_scan(df, [*keys, ts], [tie], max_group_rows, **{out: position()})


def shifted_time(ts: str, rank: str, step_ms: int = 1) -> Column:
    return F.col(ts) + millis_interval(F.col(rank) * F.lit(step_ms))


def spread_ties(
    df: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    tie: str = "id",
    step_ms: int = 1,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Move tied rows apart by ``step_ms`` per rank; a row on its own has rank 0 and stays."""
    ranked = tie_rank(df, keys, ts, tie, "_rank", max_group_rows)
    return ranked.withColumn(ts, shifted_time(ts, "_rank", step_ms)).drop("_rank")


def in_tie(
    df: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    tie: str = "id",
    out: str = "in_tie",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mark rows whose time occurs more than once for their key: one before or one behind."""
    scanned = ordered_scan(df, [*keys, ts], [tie], max_group_rows, _rank=position(), _next=following(tie))
    alike = (F.col("_rank") > 0) | F.col("_next").isNotNull()
    return scanned.withColumn(out, alike).drop("_rank", "_next")


def gap(
    df: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    tie: Sequence[str] = (),
    out: str = "gap",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Time since the previous row of the key as an interval; null on the first row."""
    scanned = ordered_scan(df, keys, [ts, *tie], max_group_rows, _previous=previous(ts))
    return scanned.withColumn(out, F.col(ts) - F.col("_previous")).drop("_previous")


def row_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """0-based place of each row of its key in the given order."""
    return ordered_scan(df, keys, order, max_group_rows, **{out: position()})


# Periods of the table that a slice is looked up in.
SLICE_PERIOD_S = 3_600


def _slice_span(
    df: DataFrame, keys: Sequence[str], ts: str, lo: int, hi: int, period_s: int, max_group_rows: int | None
) -> DataFrame:
    """Per key with rows at these places: the first and last period they lie in, and the rows before it."""
    counts = stored(df.groupBy(*keys, period_of(ts, period_s).alias("_p")).agg(F.count(F.lit(1)).alias("_n")), "slice")
    upto = ordered_scan(counts, keys, ["_p"], max_group_rows, _upto=running_sum(F.col("_n")))
    held = upto.filter((F.col("_upto") > lo) & (F.col("_upto") - F.col("_n") < hi))
    before = F.min(F.col("_upto") - F.col("_n")).alias("_before")
    return held.groupBy(*keys).agg(F.min("_p").alias("_from"), F.max("_p").alias("_to"), before)


def positional_slice(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], lo: int, hi: int,
    max_group_rows: int | None = MAX_GROUP_ROWS, period_s: int = SLICE_PERIOD_S,
) -> DataFrame:
    """Rows at 0-based places ``lo`` up to but not with ``hi``, per key or, without keys, overall.

    Where the order begins with a time, the rows per key and period are counted first: they say in
    which periods the places lie and how many rows stand before. Only rows of these periods are
    read again, by a filter on the time with literal bounds that reaches the scan, and numbered from
    the known start on. Rows without a time stand first. Other orders are numbered as a whole. Both
    ways go through ordered scans, so neither a hot key nor a hot moment comes together in one task.
    """
    if not isinstance(df.schema[order[0]].dataType, T.TimestampType):
        placed = row_position(df, keys, order, "_n", max_group_rows)
        return placed.filter((F.col("_n") >= lo) & (F.col("_n") < hi)).drop("_n")
    ts, none = F.col(order[0]), F.lit(NO_TIME)
    spans = stored(_slice_span(df, keys, order[0], lo, hi, period_s, max_group_rows), "slice")
    row = spans.agg(
        F.min(F.nullif("_from", none)).alias("first"), F.max("_to").alias("last"),
        F.coalesce(F.bool_or(F.col("_from") == none), F.lit(False)).alias("untimed"), F.min("_before").alias("before"),
    ).first()
    if row["last"] is None:
        return df.limit(0)

    def begin(period: int) -> Column:
        return F.timestamp_seconds(F.lit(period * period_s))

    if row["last"] == NO_TIME:
        near = ts.isNull()
    elif row["untimed"]:
        # A key whose places begin without a time goes on with its first times.
        near = ts.isNull() | (ts < begin(row["last"] + 1))
    else:
        near = (ts >= begin(row["first"])) & (ts < begin(row["last"] + 1))
    part = df.filter(near)
    if keys:
        own = spans.withColumnsRenamed({k: f"_s_{k}" for k in keys})
        within = period_of(order[0], period_s).between(F.col("_from"), F.col("_to"))
        for k in keys:
            within = within & part[k].eqNullSafe(own[f"_s_{k}"])
        part = part.join(own, within).select(*df.columns, "_before")
    else:
        part = part.withColumn("_before", F.lit(row["before"]))
    placed = row_position(part, keys, order, "_n", max_group_rows)
    at = F.col("_n") + F.col("_before")
    return placed.filter((at >= lo) & (at < hi)).drop("_n", "_before")


def intervals(
    bounds: DataFrame, keys: Sequence[str] = ("item",), ts: str = "time_stamp",
    max_group_rows: int | None = MAX_GROUP_ROWS, tie: Sequence[str] = (),
) -> DataFrame:
    """Each row with the time of the next row of its key as ``end``; the last row has none and goes."""
    ended = ordered_scan(bounds, keys, [ts, *tie], max_group_rows, end=following(ts))
    return ended.filter(F.col("end").isNotNull()).withColumnRenamed(ts, "start")


def _bin_width(spans: DataFrame, keys: Sequence[str]) -> int | None:
    """A bin width with few intervals per bin, or None when there is no safe one.

    With bins as wide as the mean interval the binned table has at most two rows per interval.
    Narrower bins are tried while uneven intervals crowd a bin.
    """
    row = spans.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(micros_of("end") - micros_of("start")).alias("mean"),
    ).first()
    if not row["n"] or row["n"] > MAX_BROADCAST_INTERVALS or not row["mean"]:
        return None
    for shrink in (1, 4, 16):
        width = max(1, int(row["mean"] / shrink))
        crowd = (
            _binned(spans, width).groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n").alias("top"), F.sum("n").alias("rows")).first()
        )
        if crowd["top"] is None or crowd["rows"] > MAX_BROADCAST_BINS:
            return None
        if crowd["top"] <= MAX_INTERVALS_PER_BIN:
            return width
    return None


def _bin_of(ts: Column, width: int) -> Column:
    return F.floor(micros_of(ts) / F.lit(width))


def _binned(spans: DataFrame, width: int) -> DataFrame:
    """One row per bin an interval touches; empty intervals touch none."""
    last = F.floor((micros_of("end") - 1) / F.lit(width))
    return spans.filter(F.col("start") < F.col("end")).withColumn(
        "_bin", F.explode(F.sequence(_bin_of(F.col("start"), width), last))
    )


def _sums_by_bins(spans, readings, keys, ts, value, width) -> DataFrame:
    binned = _binned(spans, width)
    right = binned.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_bin", "start", "end")
    within = _bin_of(readings[ts], width) == right["_bin"]
    for k in keys:
        within = within & readings[k].eqNullSafe(right[f"_b_{k}"])
    hit = within & (readings[ts] >= right["start"]) & (readings[ts] < right["end"])
    return (
        readings.join(F.broadcast(right), hit).groupBy(*keys, "start", "end")
        .agg(F.sum(value).alias("_sum"))
    )


def _sums_by_scan(spans, readings, keys, ts, value, max_group_rows, kind) -> DataFrame:
    # Starts and readings in one time order; each reading belongs to the newest start before it.
    # At equal times the starts come first, empty intervals before the one that holds rows.
    starts = spans.select(
        *keys, F.col("start").alias("_t"), F.lit(0).alias("_side"), F.col("end").alias("_e"),
        F.struct("start", "end").alias("_span"), F.lit(None).cast(kind).alias("_v"),
    )
    # Readings at one time share their interval, so they are added up before the sort.
    reads = readings.groupBy(*keys, F.col(ts).alias("_t")).agg(F.sum(value).cast(kind).alias("_v")).select(
        *keys, "_t", F.lit(1).alias("_side"), F.lit(None).cast("timestamp").alias("_e"),
        F.lit(None).cast(starts.schema["_span"].dataType).alias("_span"), "_v",
    )
    scanned = ordered_scan(
        starts.unionByName(reads), keys, ["_t", "_side", "_e"], max_group_rows, _in=last_known("_span")
    )
    return (
        scanned.filter((F.col("_side") == 1) & (F.col("_t") < F.col("_in.end")))
        .groupBy(*keys, F.col("_in.start").alias("start"), F.col("_in.end").alias("end"))
        .agg(F.sum("_v").alias("_sum"))
    )


def interval_sum(
    bounds: DataFrame,
    readings: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    base: str = "count",
    value: str = "count",
    max_group_rows: int | None = MAX_GROUP_ROWS,
    broadcast_bins: bool | None = None,
) -> DataFrame:
    """Per pair of neighbouring bounds: base of the first plus the readings in between.

    The result stands at the end of the interval as ``(keys, time_stamp, cumulated)``; an
    interval without readings keeps its base. Few, evenly spread intervals are broadcast, binned
    by time, so readings are joined where they lie. Otherwise bounds and readings are brought
    into one time order. ``broadcast_bins`` forces one of the two forms. Both add up in the type
    that Spark gives the sum of the readings, so fractions are kept. A null key is a key like any
    other. Jobs that look at the bounds run while the plan is made.
    """
    kind = readings.agg(F.sum(value).alias("v")).schema["v"].dataType
    # The bounds are looked at several times below; kept, they are computed once.
    kept = stored(bounds.select(*keys, ts, F.col(base).alias("_base")), "bounds")
    spans = intervals(kept, keys, ts, max_group_rows, ("_base",))
    width = None if broadcast_bins is False else _bin_width(spans, keys)
    if broadcast_bins and width is None:
        raise ValueError("the intervals are too many or too uneven to broadcast")
    if width is not None:
        sums = _sums_by_bins(spans, readings, keys, ts, value, width)
    else:
        sums = _sums_by_scan(spans, readings, keys, ts, value, max_group_rows, kind)
    cumulated = F.col("_base") + F.coalesce(F.col("_sum").cast(kind), F.lit(0).cast(kind))
    found = sums.withColumnsRenamed({c: f"_f_{c}" for c in (*keys, "start", "end")})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in (*keys, "start", "end")])
    return spans.join(found, same, "left").select(*keys, F.col("end").alias(ts), cumulated.alias("cumulated"))


def delay_series(
    events: DataFrame,
    snapshots: DataFrame,
    keys: Sequence[str] = ("item",),
    ts: str = "time_stamp",
    count: str = "count",
    tie: str = "id",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Time from the n-th event of a key to each snapshot that shows n, as a full outer join.

    ``time_x`` is the event time with ties spread, ``time_y`` the snapshot time. Many snapshots
    may show the same count. The join is written as snapshots with their event (a left join,
    whose skewed side adaptive execution can split) plus the events no snapshot shows. A null key
    is a key like any other.
    """
    placed = ordered_scan(
        events, keys, [ts, tie], max_group_rows,
        cumulated=running_sum(), _rank=position(group=[*keys, ts]),
    )
    purchases = placed.filter(F.col("cumulated").isNotNull()).select(
        *keys, "cumulated", shifted_time(ts, "_rank").alias("time_x")
    )
    shown = snapshots.select(*keys, F.col(count).cast("bigint").alias("cumulated"), F.col(ts).alias("time_y"))
    on = [*keys, "cumulated"]

    def alike(left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r_{c}"]) for c in on])

    renamed = {c: f"_r_{c}" for c in on}
    of_event = purchases.withColumnsRenamed(renamed)
    seen = shown.join(of_event, alike(shown, of_event), "left").select(*on, "time_x", "time_y")
    counts = shown.select(*on).distinct().withColumnsRenamed(renamed)
    unseen = purchases.join(counts, alike(purchases, counts), "left_anti").select(
        *on, "time_x", F.lit(None).cast("timestamp").alias("time_y")
    )
    return seen.unionByName(unseen).withColumn("delay", F.col("time_y") - F.col("time_x"))


def timeline(*parts: tuple[DataFrame, str]) -> DataFrame:
    """Frames stacked by column name, each labelled with its category; missing columns are null."""
    labelled = [df.withColumn("category", F.lit(name)) for df, name in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
