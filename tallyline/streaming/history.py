"""The snapshot history of a live view: a pointer to its newest batch, and compaction.

The history lies in one folder per micro-batch, ``epoch=/batch_id=``. Beside it are two kinds of small
files, each replaced in one step and each with one writer:

* ``epoch=N``: the newest whole batch of an epoch, written by the micro-batch, last;
* ``compacted=N``: up to which batch an epoch is compacted, and the folders that hold it.

Readers of the current counts open the pointer and the folders of two batches, however long the
history is. Readers of all of it take the compacted folders and the batches behind them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.merge import RESET_BATCH, counts_of, latest_snapshot
from tallyline.schema import REALTIME_VIEW
from tallyline.sources.folders import child_names, ensure_folder, read_text, remove, replace_text
from tallyline.sources.views import no_rows, read_view

# Rows of one compacted file, and folders of an epoch before they are made one.
ROWS_PER_FILE = 1_000_000
MAX_SEGMENTS = 8


def _pointers(realtime: str) -> str:
    return f"{realtime}_pointer"


def _segments(realtime: str, epoch: int) -> str:
    return f"{realtime}_segments/epoch={epoch}"


def point_to(spark: SparkSession, realtime: str, epoch: int, batch_id: int) -> None:
    """Name a batch that is whole. A batch that is run again does not take the pointer back."""
    newest = newest_batch(spark, realtime, epoch)
    if newest is None or batch_id > newest:
        ensure_folder(spark, _pointers(realtime))
        replace_text(spark, f"{_pointers(realtime)}/epoch={epoch}", json.dumps({"batch_id": batch_id}))


def newest_batch(spark: SparkSession, realtime: str, epoch: int) -> int | None:
    text = read_text(spark, f"{_pointers(realtime)}/epoch={epoch}")
    return None if text is None else json.loads(text)["batch_id"]


def known_epochs(spark: SparkSession, realtime: str) -> list[int]:
    """Epochs with a pointer, oldest first."""
    names = child_names(spark, _pointers(realtime))
    return sorted(int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch="))


def _compacted(spark: SparkSession, realtime: str, epoch: int) -> dict:
    text = read_text(spark, f"{_pointers(realtime)}/compacted={epoch}")
    return json.loads(text) if text else {"upto": RESET_BATCH, "segments": [], "state": None}


def _batches(spark: SparkSession, realtime: str, epoch: int) -> list[int]:
    names = child_names(spark, f"{realtime}/epoch={epoch}")
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _read(spark: SparkSession, realtime: str, epoch: int, batches: Sequence[int]) -> DataFrame:
    """The rows of some batches; only their folders are listed."""
    folders = [f"{realtime}/epoch={epoch}/batch_id={b}" for b in batches]
    if not folders:
        return no_rows(spark, REALTIME_VIEW)
    return spark.read.schema(REALTIME_VIEW).option("basePath", realtime).parquet(*folders)


def _epoch_history(spark: SparkSession, realtime: str, epoch: int, segments: Sequence[str], upto: int) -> DataFrame:
    loose = [b for b in _batches(spark, realtime, epoch) if b > upto or b == RESET_BATCH]
    rows = _read(spark, realtime, epoch, loose)
    if segments:
        place = _segments(realtime, epoch)
        whole = spark.read.schema(REALTIME_VIEW).parquet(*[f"{place}/{s}" for s in segments])
        rows = rows.unionByName(whole)
    return rows


def read_history(spark: SparkSession, realtime: str, epoch: int | None = None) -> DataFrame:
    """Every snapshot of one epoch, or of all, each row once, compacted or not."""
    epochs = known_epochs(spark, realtime) if epoch is None else [epoch]
    out = no_rows(spark, REALTIME_VIEW)
    for number in epochs:
        done = _compacted(spark, realtime, number)
        out = out.unionByName(_epoch_history(spark, realtime, number, done["segments"], done["upto"]))
    return out


def current_snapshot(
    spark: SparkSession, realtime: str, keys: Sequence[str] = ("item",), epoch: int | None = None, mode: str = "complete"
) -> DataFrame:
    """What ``latest_snapshot`` gives over the whole history, from the pointer and the newest folders alone.

    In complete mode these are the newest batch and the zero rows of the reset; in update mode the
    counts as of the last compaction and the batches behind it. A view without a pointer, written by
    another program, is read whole.
    """
    known = known_epochs(spark, realtime)
    if not known:
        return latest_snapshot(read_view(spark, realtime, REALTIME_VIEW), keys, mode, epoch)
    epoch = known[-1] if epoch is None else epoch
    if mode == "complete":
        newest = newest_batch(spark, realtime, epoch)
        wanted = {b for b in (newest, RESET_BATCH) if b is not None}
        there = [b for b in _batches(spark, realtime, epoch) if b in wanted]
        return counts_of(_read(spark, realtime, epoch, there), keys)
    done = _compacted(spark, realtime, epoch)
    state = [done["state"]] if done["state"] else []
    return counts_of(_epoch_history(spark, realtime, epoch, state, done["upto"]), keys)


def unit_delays(history: DataFrame, files: DataFrame) -> DataFrame:
    """Per unit the time from its newest file to the first snapshot that shows all of its events.

    ``history`` is a live view by item and unit, ``files`` lists ``(unit, time)`` (``topic_files``). Units
    that are not wholly shown yet have no delay.
    """
    per_snapshot = history.groupBy("unit", "batch_id").agg(F.sum("count").alias("n"), F.min("time_stamp").alias("shown"))
    whole = per_snapshot.groupBy("unit").agg(F.min_by("shown", F.struct(-F.col("n"), F.col("shown"))).alias("shown"))
    written = files.groupBy("unit").agg(F.max("time").alias("written"))
    both = written.join(whole, "unit")
    return both.withColumn("delay_ms", F.unix_millis("shown") - F.unix_millis("written")).filter("delay_ms >= 0")


def appended_once(rows: DataFrame) -> DataFrame:
    """Rows of a store that only appends, each once: of those with one ``id`` the one that came first.

    ``write_snapshot`` in append mode makes the ``id`` from epoch, batch and key, so a batch that is
    run again writes the same ids.
    """
    first = F.min_by(F.struct(*rows.columns), "time_stamp")
    return rows.groupBy("id").agg(first.alias("r")).select("r.*")


def compact_history(
    spark: SparkSession, realtime: str, epoch: int, mode: str = "complete", rows_per_file: int = ROWS_PER_FILE,
    max_segments: int = MAX_SEGMENTS,
) -> int:
    """Write the batches before the newest one of an epoch into few files, and return the last one of them.

    Every answer stays as it is: all rows are kept, and readers go over to the new files in one step,
    when these are whole. The old folders stay until ``drop_compacted``, for readers under way. For
    a view in update mode the current counts are kept beside them, so readers need not go back.
    After ``max_segments`` runs all compacted files of the epoch become one folder again. One
    compaction of an epoch runs at a time; live queries go on meanwhile.
    """
    newest, done = newest_batch(spark, realtime, epoch), _compacted(spark, realtime, epoch)
    fresh = [b for b in _batches(spark, realtime, epoch) if newest is not None and done["upto"] < b < newest and b != RESET_BATCH]
    if not fresh:
        return done["upto"]
    place, upto = _segments(realtime, epoch), fresh[-1]
    rows, kept = _read(spark, realtime, epoch, fresh), list(done["segments"])
    if len(kept) >= max_segments:
        rows, kept = rows.unionByName(spark.read.schema(REALTIME_VIEW).parquet(*[f"{place}/{s}" for s in kept])), []
    files = max(1, -(-rows.count() // rows_per_file))
    name = f"upto={upto}"
    (
        rows.repartitionByRange(files, "item", "batch_id", "unit").sortWithinPartitions("item", "batch_id", "unit")
        .write.mode("overwrite").parquet(f"{place}/{name}")
    )
    state = None
    if mode == "update":
        state = f"state={upto}"
        old = [f"{place}/{done['state']}"] if done["state"] else []
        before = spark.read.schema(REALTIME_VIEW).parquet(*old) if old else no_rows(spark, REALTIME_VIEW)
        row = F.struct(*REALTIME_VIEW.names)
        latest = _read(spark, realtime, epoch, fresh).unionByName(before).groupBy("item", "unit")
        latest.agg(F.max_by(row, "batch_id").alias("r")).select("r.*").write.mode("overwrite").parquet(f"{place}/{state}")
    replace_text(
        spark, f"{_pointers(realtime)}/compacted={epoch}",
        json.dumps({"upto": upto, "segments": [*kept, name], "state": state}),
    )
    return upto


def drop_compacted(spark: SparkSession, realtime: str, epoch: int) -> int:
    """Remove folders that compaction has replaced and return their number. For when no old reader is left."""
    done = _compacted(spark, realtime, epoch)
    old = [f"{realtime}/epoch={epoch}/batch_id={b}" for b in _batches(spark, realtime, epoch) if RESET_BATCH < b <= done["upto"]]
    place, used = _segments(realtime, epoch), {*done["segments"], done["state"]}
    old += [f"{place}/{n}" for n in child_names(spark, place) if n not in used]
    return sum(remove(spark, path) for path in old)
