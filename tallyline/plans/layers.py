"""Batch layer and serving layer, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.decode import decode_rows
from tallyline.operators.counts import count_items
from tallyline.operators.merge import serving_view, without_units
from tallyline.schema import BATCH_VIEW, EPOCH_TABLE
from tallyline.session import stored
from tallyline.sources.folders import exists, remove
from tallyline.sources.topics import SETTLE_S, file_record, read_events, source_of, topic_files
from tallyline.sources.views import read_view
from tallyline.streaming.epochs import active_epoch, active_table, covered_units, publish_run, write_run
from tallyline.streaming.history import current_snapshot

NO_RUN = -1
# Changed units that go into a filter; more are joined.
FEW_UNITS = 1_000


def _overwrite(rows: DataFrame, path: str, run_id: int) -> DataFrame:
    """Store the rows as the folder of one run, in place of an earlier try, and read it back."""
    write_run(rows, path, run_id)
    run = F.lit(run_id).cast("bigint")
    schema = rows.withColumn("run_id", run).schema
    return read_view(rows.sparkSession, path, schema).filter(F.col("run_id") == run)


def run_batch_view(
    events: DataFrame,
    view: str,
    run_id: int,
    epoch_table: str | None = None,
    keys: Sequence[str] = ("item",),
    before: str | None = None,
    skip_open: bool = False,
) -> DataFrame:
    """Count the archive anew and store the totals under ``run_id``.

    ``events`` has ``item`` and ``unit``. A run must keep to closed units: ``before`` reads only
    units that sort below it, ``skip_open`` leaves out the newest unit of each source. The archive
    is read once, to counts per unit and key; totals and the list of covered units come from that
    small table. The units are published last, so readers never see a run that is not whole.
    """
    closed = events if before is None else events.filter(F.col("unit") < before)
    per_unit = _overwrite(count_items(closed, ["unit", *keys]), f"{view}_units", run_id)
    return _finish_run(per_unit, view, run_id, epoch_table, keys, skip_open)


def _finish_run(
    per_unit: DataFrame, view: str, run_id: int, epoch_table: str | None, keys: Sequence[str], skip_open: bool
) -> DataFrame:
    """Store the totals out of the counts per unit, then publish the units."""
    if skip_open:
        newest = per_unit.groupBy(source_of("unit")).agg(F.max("unit").alias("unit")).select("unit")
        per_unit = without_units(per_unit, newest)
    totals = per_unit.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("count"))
    stamped = totals.withColumns({"time_stamp": F.current_timestamp(), "id": F.uuid()})
    stored_run = _overwrite(stamped, view, run_id)
    if epoch_table:
        publish_run(per_unit, epoch_table, run_id)
    return stored_run


def _units_table(spark: SparkSession, view: str, run_id: int, keys: Sequence[str]) -> DataFrame:
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in ("unit", *keys)], T.StructField("count", T.LongType())])
    return read_view(spark, f"{view}_units/run_id={run_id}", schema)


def changed_units(spark: SparkSession, files: DataFrame, view: str, since_run: int, covered: DataFrame) -> DataFrame:
    """Units of an archive that a run must count again: those with files newer than ``since_run``, and those it left out.

    Told from names and times of its files (``topic_files``) alone.
    """
    known = read_view(spark, f"{view}_files/run_id={since_run}", "since TIMESTAMP, file STRING")
    since = known.agg(F.max("since").alias("t")).first()["t"]
    if since is None:
        return files.select("unit").distinct()
    late = files.filter(F.col("time") >= F.lit(since)).join(known.filter("file IS NOT NULL").select("file"), "file", "left_anti")
    return late.select("unit").unionByName(without_units(files.select("unit"), covered)).distinct()


def run_batch_increment(
    spark: SparkSession,
    location: str,
    view: str,
    run_id: int,
    epoch_table: str,
    keys: Sequence[str] = ("item",),
    skip_open: bool = False,
    settle_s: int = SETTLE_S,
    few_units: int = FEW_UNITS,
) -> DataFrame:
    """The totals that ``run_batch_view`` would store, from the counts of the last published run and the units changed since.

    Each run keeps its counts per unit and a record of the files that it saw. A unit is counted again,
    as a whole, when it has a file that the last run did not see, be it new, left open or late; the folders of
    all other units are not read. The first run reads all. Files may take ``settle_s`` from their time
    to their commit. As the record is taken before the count, a file that comes meanwhile is
    counted again next time.
    """
    record = f"{view}_files/run_id={run_id}"
    remove(spark, record)
    # Listed once, for the record and for what has changed.
    files = stored(topic_files(spark, location), "files")
    file_record(spark, location, record, settle_s, files)
    published = read_view(spark, epoch_table, EPOCH_TABLE).filter(F.col("run_id") < run_id)
    last = published.agg(F.max("run_id").alias("r")).first()["r"]
    log = read_events(spark, "text", location)
    if last is None or not exists(spark, f"{view}_files/run_id={last}"):
        counts = count_items(decode_rows(log, fields=["item"]), ["unit", *keys])
    else:
        before = _units_table(spark, view, last, keys)
        changed = stored(changed_units(spark, files, view, last, covered_units(spark, epoch_table, last)), "changed")
        names = [r["unit"] for r in changed.limit(few_units + 1).collect()]
        if len(names) <= few_units:
            # At most ``few_units`` names; as literals they leave out the folders of all other units.
            named = F.col("unit").isin([n for n in names if n is not None])
            again = log.filter(named | F.col("unit").isNull() if None in names else named)
        else:
            again = log.join(changed.withColumnRenamed("unit", "_unit"), F.col("unit").eqNullSafe(F.col("_unit")), "left_semi")
        recount = count_items(decode_rows(again, fields=["item"]), ["unit", *keys])
        counts = without_units(before, changed).select("unit", *keys, "count").unionByName(recount)
    return _finish_run(_overwrite(counts, f"{view}_units", run_id), view, run_id, epoch_table, keys, skip_open)


def served_totals(
    spark: SparkSession, batch_view: str, realtime_view: str, epoch_table: str,
    keys: Sequence[str] = ("item",), active: str | None = None, mode: str = "complete",
) -> DataFrame:
    """Current total per key: the newest published batch run plus the live counts behind it.

    The run is read once, as a number, so a run published meanwhile cannot be mixed in. The live
    counts come from the active epoch, which the table ``active`` names (by default the one that
    lies beside the live view); a new epoch is not served before ``activate_epoch``. ``mode`` is the
    output mode that the live view is written in.
    """
    published = read_view(spark, epoch_table, EPOCH_TABLE)
    run_id = published.agg(F.coalesce(F.max("run_id"), F.lit(NO_RUN)).alias("r")).first()["r"]
    batch = read_view(spark, batch_view, BATCH_VIEW).filter(F.col("run_id") == run_id)
    epoch = active_epoch(spark, active or active_table(realtime_view), realtime_view)
    live = current_snapshot(spark, realtime_view, [*keys, "unit"], epoch, mode)
    return serving_view(batch, live, covered_units(spark, epoch_table, run_id), keys)
