"""Ordered scans: running sums, ranks, neighbours and last-known values that survive hot groups.

A window over a group puts that group into one task. Here a group may hold a third of all rows,
so sizes are looked at first, and the rows are cut in one of three ways:

* ``whole``: every group is small enough; plain windows, one shuffle. A group that is the whole
  table, with no key to shuffle by, is left whole only up to a thousand rows.
* ``periods``: the order starts with a time, and some period (a day down to a second) cuts
  every group into parts that are small enough. A part is a function of the row, so the rows
  are shuffled once, by group and period, as in the plain form.
* ``ranges``: otherwise, as when one moment holds a third of the rows. The rows are copied once, and
  the copy is range-partitioned by the whole sort key and written, since range bounds are sampled anew
  in each run of a plan and two runs could cut the data at different places.

The input is read twice: once for a small table with a row per group and second, which holds the
sizes and what each second passes on, and once for the rows themselves. What a part needs from
its neighbours comes from that table by a tree of prefix sums, ``FANOUT`` parts to a node, so no task
sees all parts of a group. It goes into the part as an extra first (or last) row of the window; no
join with the rows is needed.

The sort key (group columns, then order columns) must be unique for a repeatable result: end the
order with an id. Weights with a binary point are added up as decimals with ``EXACT`` places, so their
sums do not depend on how the rows were cut; such a weight must be finite and below 1e26, or the query fails.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.session import stored

MAX_GROUP_ROWS = 1_000_000
SMALL_TABLE = 1_000
FANOUT = 4_096
PERIODS_S = (86_400, 3_600, 60, 1)
# The period of rows without a time, which come first in the order.
NO_TIME = -(2**62)
PART = "_scan_part"
KIND = "_scan_kind"
EXACT = T.DecimalType(38, 12)
COPY = "_scan_copy"
HEAD, ROW, TAIL = 0, 1, 2


@dataclass(frozen=True)
class Scan:
    """One computed column: ``kind`` over rows of the same ``group`` in sort order."""

    kind: str
    value: Column | str
    group: tuple[str, ...] | None = None

    @property
    def column(self) -> Column:
        return F.col(self.value) if isinstance(self.value, str) else self.value


def running_sum(value: Column | int = 1, group: Sequence[str] | None = None) -> Scan:
    """Sum of ``value`` up to and with this row."""
    return Scan("sum", F.lit(value).cast("bigint") if isinstance(value, int) else value, _own(group))


def position(group: Sequence[str] | None = None) -> Scan:
    """Number of earlier rows, so the first row has 0."""
    return Scan("position", F.lit(1).cast("bigint"), _own(group))


def previous(value: str, group: Sequence[str] | None = None) -> Scan:
    """The value one row back, null on the first row."""
    return Scan("previous", value, _own(group))


def following(value: str, group: Sequence[str] | None = None) -> Scan:
    """The value one row on, null on the last row."""
    return Scan("following", value, _own(group))


def last_known(value: str, group: Sequence[str] | None = None) -> Scan:
    """The newest non-null value up to and with this row."""
    return Scan("last_known", value, _own(group))


def _own(group: Sequence[str] | None) -> tuple[str, ...] | None:
    return None if group is None else tuple(group)


def _over(scan: Scan, value: Column, window) -> Column:
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    if scan.kind == "sum":
        return F.sum(value).over(so_far)
    if scan.kind == "position":
        return F.sum(value).over(so_far) - 1
    if scan.kind == "previous":
        return F.lag(value).over(window)
    if scan.kind == "following":
        return F.lead(value).over(window)
    return F.last(value, ignorenulls=True).over(so_far)


def _edge(scan: Scan, order: Sequence[str]) -> Column:
    """What a part passes on about a group in it."""
    at = F.struct(*order)
    if scan.kind in ("sum", "position"):
        return F.sum(scan.column)
    if scan.kind == "previous":
        # The last time of a part is its greatest; a plain maximum can be hashed.
        return F.max(scan.column) if scan.value == order[0] else F.max_by(scan.column, at)
    if scan.kind == "following":
        return F.min_by(scan.column, at)
    return F.max_by(scan.column, F.when(scan.column.isNotNull(), at))


def _carry(scan: Scan, edge: Column, parts) -> Column:
    """What reaches a part from its neighbours."""
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    if scan.kind in ("sum", "position"):
        return F.sum(edge).over(earlier)
    if scan.kind == "previous":
        return F.lag(edge).over(parts)
    if scan.kind == "following":
        return F.lead(edge).over(parts)
    return F.last(edge, ignorenulls=True).over(earlier)


def _joined_edge(scan: Scan, edge: str, order: Sequence[str], at: str) -> Column:
    """What several neighbouring pieces pass on together, out of what each does; ``at`` is their order."""
    if scan.kind in ("sum", "position"):
        return F.sum(edge)
    if scan.kind == "previous":
        return F.max(edge) if scan.value == order[0] else F.max_by(edge, at)
    if scan.kind == "following":
        return F.min_by(edge, at)
    return F.max_by(edge, F.when(F.col(edge).isNotNull(), F.col(at)))


def _carried(
    edges: DataFrame, group: Sequence[str], order: Sequence[str], scans: dict[str, Scan], parts: int, fanout: int
) -> DataFrame:
    """What reaches each part, out of one row per part and group; no group has more than ``parts`` parts.

    Up to ``fanout`` parts are put in order in one task. More are joined to nodes of ``fanout`` parts
    first, which are treated alike; a part gets what reaches its node and what is before it there.
    """
    ins = {o: f"_scan_in_{o}" for o in scans}
    if parts <= fanout:
        window = Window.partitionBy(*group).orderBy(PART)
        return edges.select(PART, *group, *[_carry(s, F.col(ins[o]), window).alias(ins[o]) for o, s in scans.items()])
    node = F.floor(F.col(PART) / F.lit(fanout)).cast("bigint")
    edges = edges.withColumn("_scan_node", node)
    nodes = edges.groupBy("_scan_node", *group).agg(
        *[_joined_edge(s, ins[o], order, PART).alias(ins[o]) for o, s in scans.items()]
    ).withColumnRenamed("_scan_node", PART)
    above = _carried(nodes, group, order, scans, -(-parts // fanout), fanout)
    above = above.select(
        F.col(PART).alias("_up_node"), *[F.col(g).alias(f"_up_{g}") for g in group], *[F.col(i).alias(f"_up{i}") for i in ins.values()]
    )
    window = Window.partitionBy("_scan_node", *group).orderBy(PART)
    within = edges.select(
        PART, "_scan_node", *group, *[_carry(s, F.col(ins[o]), window).alias(ins[o]) for o, s in scans.items()],
        F.row_number().over(window).alias("_first"), F.lead(F.lit(True), 1, False).over(window).alias("_more"),
    )
    same = F.col("_scan_node") == F.col("_up_node")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_up_{g}"))
    reached = []
    for o, scan in scans.items():
        own, up = F.col(ins[o]), F.col(f"_up{ins[o]}")
        if scan.kind in ("sum", "position"):
            got = F.coalesce(own + up, own, up).cast(edges.schema[ins[o]].dataType)
        elif scan.kind == "previous":
            got = F.when(F.col("_first") == 1, up).otherwise(own)
        elif scan.kind == "following":
            got = F.when(F.col("_more"), own).otherwise(up)
        else:
            got = F.coalesce(own, up)
        reached.append(got.alias(ins[o]))
    return within.join(above, same, "left").select(PART, *group, *reached)


def _at_the_ends(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of the first and the last group of each range; only these go on in another range."""
    if not group:
        return rows
    key = F.struct(*group)
    ends = rows.groupBy(PART).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    return rows.join(stored(ends, "ends"), PART).filter(
        key.eqNullSafe(F.col("_first")) | key.eqNullSafe(F.col("_last"))
    )


def _scan_parts(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], scans: dict[str, Scan], carried: DataFrame,
    finer: dict[tuple[str, ...], dict[str, Scan]] | None = None,
) -> DataFrame:
    """Windows within the parts, with the carried values as extra rows before and after."""
    forward = {o for o, s in scans.items() if s.kind == "following"}
    ends = [(HEAD, set(scans) - forward), (TAIL, forward)]
    values = {f"_scan_in_{o}": s.column for o, s in scans.items()}
    both = rows.withColumns({**values, KIND: F.lit(ROW)})
    for kind, outs in ends:
        if outs:
            end = carried.select(PART, *group, *[f"_scan_in_{o}" for o in outs], F.lit(kind).alias(KIND))
            both = both.unionByName(end, allowMissingColumns=True)
    window = Window.partitionBy(PART, *group).orderBy(KIND, *order)
    out = both.withColumns({o: _over(s, F.col(f"_scan_in_{o}"), window) for o, s in scans.items()})
    for own, members in (finer or {}).items():
        # A finer group lies within one part. KIND keeps the extra rows out of it.
        rest = [*group, *order][len(own):]
        inner = Window.partitionBy(PART, *group, KIND, *own[len(group):]).orderBy(*rest)
        out = out.withColumns({o: _over(s, s.column, inner) for o, s in members.items()})
    return out.filter(F.col(KIND) == ROW).drop(KIND, *values)


def period_of(ts: str, seconds: int) -> Column:
    return F.coalesce(F.floor(F.unix_seconds(ts) / F.lit(seconds)), F.lit(NO_TIME))


def _timed(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampType)


def _counted(df: DataFrame, group: Sequence[str], ts: str | None, order: Sequence[str], scans: dict[str, Scan]) -> DataFrame:
    """Rows per group and second, with what each second passes on; without a time, rows per group."""
    second = period_of(ts, 1) if ts else F.lit(0).cast("bigint")
    edges = [_edge(s, order).alias(f"_scan_in_{o}") for o, s in scans.items()] if ts else []
    counts = df.groupBy(*group, second.alias("_s")).agg(F.count(F.lit(1)).alias("_n"), *edges)
    return stored(counts, "counts")


def _sizes(counts: DataFrame, group: Sequence[str], per_second: bool) -> tuple[int, int]:
    """Rows in the largest group (or second of one) and in all; one row comes back to the driver."""
    sizes = counts if per_second else counts.groupBy(*group).agg(F.sum("_n").alias("_n"))
    row = sizes.agg(F.max("_n").alias("top"), F.sum("_n").alias("total")).first()
    return row["top"] or 0, row["total"] or 0


def _period(counts: DataFrame, group: Sequence[str], limit: int) -> tuple[int, int] | None:
    """The longest period that cuts all groups into parts within ``limit``, and the most parts of a group."""
    for seconds in PERIODS_S:
        parts = counts.groupBy(*group, F.floor(F.col("_s") / F.lit(seconds)).alias("_p")).agg(F.sum("_n").alias("n"))
        per_group = parts.groupBy(*group).agg(F.max("n").alias("rows"), F.count(F.lit(1)).alias("parts"))
        row = per_group.agg(F.max("rows").alias("rows"), F.max("parts").alias("parts")).first()
        if row["rows"] <= limit:
            return seconds, row["parts"]
    return None


def _exact(df: DataFrame, scans: dict[str, Scan]) -> tuple[dict[str, Scan], dict[str, Column]]:
    """The scans with sums of binary fractions taken as decimals, and their results in the type of a plain sum."""
    out, plain = {}, {}
    for name, scan in scans.items():
        if scan.kind == "sum":
            plain[name] = F.col(name).cast(df.agg(F.sum(scan.column).alias("s")).schema["s"].dataType)
            if isinstance(df.select(scan.column).schema[0].dataType, (T.DoubleType, T.FloatType)):
                scan = Scan("sum", scan.column.cast(EXACT), scan.group)
        out[name] = scan
    return out, plain


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    max_group_rows: int | None = MAX_GROUP_ROWS,
    fanout: int = FANOUT,
    **scans: Scan,
) -> DataFrame:
    """Add one column per keyword, computed over ``group`` in ``order``.

    A scan may name a finer group of its own: ``group`` followed by the first few order columns.
    ``max_group_rows=None`` leaves out the size check, for groups known to be small.
    """
    group, order = list(group), list(order)
    sort = group + order
    wanted = [*df.columns, *scans]
    exact, plain = _exact(df, scans)
    levels: dict[tuple[str, ...], dict[str, Scan]] = {tuple(group): {}}
    for out, scan in exact.items():
        own = tuple(group) if scan.group is None else scan.group
        if list(own) != sort[: max(len(own), len(group))]:
            raise ValueError(f"group {own} of {out} must be {group} and the first of {order}")
        levels.setdefault(own, {})[out] = scan
    levels = {own: levels[own] for own in sorted(levels, key=len) if levels[own]}

    def done(rows: DataFrame) -> DataFrame:
        return (rows.withColumns(plain) if plain else rows).select(*wanted)

    limit, top, total, counts, cut = max_group_rows, 0, 0, None, None
    if limit is not None:
        coarsest = list(min(levels, key=len))
        whole = coarsest == group
        if whole:
            # What the order begins with cuts the groups, where it is a time.
            cut = order[0] if _timed(df, order[0]) else None
            counts = _counted(df, group, cut, order, levels[tuple(group)])
        else:
            # Groups by moment can be nearly as many as the rows; no moment holds more than its second.
            moment = coarsest[-1] if _timed(df, coarsest[-1]) else None
            counts = _counted(df, coarsest[:-1] if moment else coarsest, moment, order, {})
        top, total = _sizes(counts, coarsest, per_second=not whole)
        if not coarsest:
            # The whole table is one group: cut it well before it fills a task.
            limit = min(limit, max(SMALL_TABLE, total // 8))

    if limit is None or top <= limit:
        # Coarse groups first: their shuffle and sort also serve the finer ones.
        for own, members in levels.items():
            window = Window.partitionBy(*own).orderBy(*sort[len(own):])
            df = df.withColumns({o: _over(s, s.column, window) for o, s in members.items()})
        return done(df)

    coarse = tuple(group)
    period = _period(counts, group, limit) if cut else None
    if period is not None:
        seconds, parts = period
        rows = df.withColumn(PART, period_of(cut, seconds))
        finer = {own: members for own, members in levels.items() if own != coarse}
        part = F.when(F.col("_s") == NO_TIME, F.col("_s")).otherwise(F.floor(F.col("_s") / F.lit(seconds)))
        edges = counts.withColumn(PART, part).groupBy(PART, *group).agg(
            *[_joined_edge(s, f"_scan_in_{o}", order, "_s").alias(f"_scan_in_{o}") for o, s in levels[coarse].items()]
        )
        carried = _carried(edges, group, order, levels[coarse], parts, fanout)
        return done(_scan_parts(rows, group, order, levels[coarse], carried, finer))

    n = max(2, math.ceil(total / limit))
    # Copies with one sort key would share a range; a number tells them apart.
    numbered = stored(df.withColumn(COPY, F.monotonically_increasing_id()), "copy")
    ranges = numbered.repartitionByRange(n, *sort, COPY).withColumn(PART, F.spark_partition_id().cast("bigint"))
    base = out = stored(ranges, "ranges")
    for own, members in levels.items():
        rest = [*sort[len(own):], COPY]
        ends = _at_the_ends(base, own)
        edges = ends.groupBy(PART, *own).agg(*[_edge(s, rest).alias(f"_scan_in_{o}") for o, s in members.items()])
        carried = _carried(edges, own, rest, members, n, fanout)
        out = _scan_parts(out, own, rest, members, carried)
    return done(out)
