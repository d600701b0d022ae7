"""Whole flows over the ``events`` table: live view, hand-off, epoch change, recovery, fan-out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.decode import decode_rows
from tallyline.functions.encode import encode
from tallyline.operators.counts import count_by, count_items
from tallyline.operators.merge import latest_snapshot
from tallyline.operators.questions import MACHINE, gap_profile, silence_alarms, standing_alarms
from tallyline.plans.layers import run_batch_increment, run_batch_view, served_totals
from tallyline.schema import BATCH_VIEW, EPOCH_TABLE, RAW_VIEW, REALTIME_VIEW
from tallyline.session import stored, work_dir
from tallyline.sources.tables import purchases, stream_purchases
from tallyline.sources.topics import read_archive_json, read_events, topic_files
from tallyline.sources.views import ensure_view, read_view
from tallyline.streaming.compaction import compact_archive, read_archive_lines
from tallyline.streaming.control import emit_restart, on_restart
from tallyline.streaming.epochs import activate_epoch, active_table, covered_units, publish_cut, rotate_epoch, uncovered
from tallyline.streaming.history import appended_once, compact_history, current_snapshot, drop_compacted, read_history
from tallyline.streaming.queries import (
    AT_ONCE, DRAIN, LIVE_TRIGGER, append_raw_view, archive, lane_of, publish, replay, run_until_ok, small_batches,
    snapshot_stream, write_snapshot,
)
from tallyline.streaming.watch import BatchWatch, observed

#: Queries that read a topic file by file at the same time.
READ_LANES = 16
#: Format of topics whose files hold many units, and units of such a file.
PACKED = "parquet"
UNITS_PER_FILE = 64


def payloads(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The table as a topic shows it: ``(unit, value)``."""
    events = stream_purchases(spark, sf_dir) if streaming else purchases(spark, sf_dir)
    return encode(events, keep=("unit",))


def publish_packed(rows: DataFrame, path: str) -> None:
    """Payloads appended to a topic as the tasks hold them, whatever their units."""
    publish(rows, path, PACKED, packed=True)


def topic(spark: SparkSession, sf_dir: str, path: str, batches: int = 4) -> DataFrame:
    """The table published as a file topic and read in about ``batches`` micro-batches of whole units.

    One file for each unit; where these are many, files of about ``UNITS_PER_FILE`` units.
    """
    rows = payloads(spark, sf_dir)
    files, per_batch = files_of(rows.select("unit").distinct().count(), batches)
    if files is None:
        publish(rows.repartition("unit"), path, PACKED)
    else:
        publish_packed(rows.repartition(files, "unit"), path)
    return read_topic(spark, path, per_batch)


def read_topic(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """A topic of ``topic`` or ``publish_packed`` as a stream, with so many files a micro-batch."""
    options = {} if per_batch is None else {"maxFilesPerTrigger": str(per_batch)}
    return read_events(spark, PACKED, path, streaming=True, options=options)


def files_of(units: int, batches: int) -> tuple[int | None, int]:
    """Files of a topic with so many units (None: one for each unit), and files of one of its micro-batches.

    There are as many micro-batches as with a file for each unit.
    """
    per_batch = max(1, -(-units // batches))
    if units <= batches * UNITS_PER_FILE:
        return None, per_batch
    files = -(-per_batch // UNITS_PER_FILE)
    return -(-units // per_batch) * files, files


@dataclass(frozen=True)
class Layers:
    """Where the parts of one batch-plus-speed set-up lie."""

    batch: str
    realtime: str
    epochs: str


def hand_off(spark: SparkSession, sf_dir: str) -> Layers:
    """Run the speed layer over everything and a batch run over the closed units.

    The newest unit is still open, so the batch run leaves it to the speed layer.
    """
    work = work_dir(spark, "layers")
    layers = Layers(f"{work}/batch", f"{work}/realtime", f"{work}/epochs")
    ensure_view(spark, layers.batch, BATCH_VIEW, ("run_id",))
    ensure_view(spark, layers.epochs, EPOCH_TABLE, ("run_id",))
    live = stream_purchases(spark, sf_dir).select("item", "unit")
    snapshot_stream(
        live, layers.realtime, f"{work}/checkpoint", ["item", "unit"], trigger=DRAIN
    ).awaitTermination()
    events = purchases(spark, sf_dir).select("item", "unit")
    run_batch_view(events, layers.batch, 1, layers.epochs, skip_open=True)
    return layers


def epoch_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per epoch when the live view is restarted behind a published batch run."""
    layers = hand_off(spark, sf_dir)
    epoch = rotate_epoch(spark, layers.realtime, ["item"])
    rest = uncovered(
        stream_purchases(spark, sf_dir).select("item", "unit"), covered_units(spark, layers.epochs)
    )
    snapshot_stream(
        rest, layers.realtime, f"{layers.realtime}_checkpoint_{epoch}", ["item", "unit"], epoch, DRAIN
    ).awaitTermination()
    view = read_view(spark, layers.realtime, REALTIME_VIEW)
    per_epoch = []
    for number in range(epoch + 1):
        counts = latest_snapshot(view, ["item", "unit"], epoch=number)
        per_epoch.append(
            counts.groupBy("item").agg(F.sum("count").cast("bigint").alias("count"))
            .withColumn("epoch", F.lit(number).cast("bigint"))
        )
    out = per_epoch[0]
    for more in per_epoch[1:]:
        out = out.unionByName(more)
    return out


def recovered_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live totals of a query whose second micro-batch fails after its write and is run again."""
    work = work_dir(spark, "recovery")
    write = write_snapshot(f"{work}/view", 0)
    failed = []
    events = topic(spark, sf_dir, f"{work}/topic")

    def fail_once(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    run_until_ok(
        lambda: snapshot_stream(events, f"{work}/view", f"{work}/checkpoint", trigger=DRAIN, callback=fail_once),
        wait_s=0.1,
    )
    return latest_snapshot(read_view(spark, f"{work}/view", REALTIME_VIEW))


def replayed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a live view fed in several micro-batches beside those of one rebuilt from the whole log at once."""
    work = work_dir(spark, "replay")
    views = {}
    first = topic(spark, sf_dir, f"{work}/topic")
    again = read_topic(spark, f"{work}/topic")
    snapshot_stream(first, f"{work}/first", f"{work}/first_checkpoint", trigger=DRAIN).awaitTermination()
    replay(again, f"{work}/replayed", f"{work}/replayed_checkpoint").awaitTermination()
    for name in ("first", "replayed"):
        view = read_view(spark, f"{work}/{name}", REALTIME_VIEW)
        views[name] = latest_snapshot(view).withColumnRenamed("count", name)
    return views["first"].join(views["replayed"], "item", "full")


def archive_log(spark: SparkSession, sf_dir: str) -> str:
    """Stream the table's payloads into an archive and return its folder."""
    work = work_dir(spark, "archive")
    archive(payloads(spark, sf_dir, streaming=True), f"{work}/log", f"{work}/checkpoint").awaitTermination()
    return f"{work}/log"


def archived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after a trip through the archive: encoded, appended, scanned, decoded."""
    return decode_rows(read_events(spark, "text", archive_log(spark, sf_dir)))


def validation_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-event view as its consumer stored it."""
    work = work_dir(spark, "validation")
    append_raw_view(payloads(spark, sf_dir, streaming=True), f"{work}/view", f"{work}/checkpoint").awaitTermination()
    return read_view(spark, f"{work}/view", RAW_VIEW)


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each of three consumers of one topic took in."""
    work = work_dir(spark, "fan-out")
    topic = payloads(spark, sf_dir, streaming=True)
    consumers = [
        archive(topic, f"{work}/archive", f"{work}/archive_checkpoint"),
        append_raw_view(topic, f"{work}/validation", f"{work}/validation_checkpoint"),
        snapshot_stream(topic, f"{work}/live", f"{work}/live_checkpoint", trigger=DRAIN),
    ]
    for query in consumers:
        query.awaitTermination()
    lines = read_events(spark, "text", f"{work}/archive").agg(F.count(F.lit(1)).alias("rows"))
    stored_rows = read_view(spark, f"{work}/validation", RAW_VIEW).agg(F.count(F.lit(1)).alias("rows"))
    live = latest_snapshot(read_view(spark, f"{work}/live", REALTIME_VIEW)).agg(
        F.sum("count").cast("bigint").alias("rows")
    )
    named = [
        rows.select(F.lit(name).alias("consumer"), "rows")
        for name, rows in (("archive", lines), ("validation", stored_rows), ("live", live))
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def batch_runs(spark: SparkSession, sf_dir: str, cuts: tuple[str | None, ...]) -> DataFrame:
    """Batch view history of full runs over an archive that grows up to each cut."""
    view = f"{work_dir(spark, 'batch')}/view"
    events = purchases(spark, sf_dir).select("item", "unit")
    for run_id, cut in enumerate(cuts, start=1):
        run_batch_view(events, view, run_id, before=cut)
    return read_view(spark, view, BATCH_VIEW).select("run_id", "item", "count")


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of four incremental runs beside those of full ones, over an archive that grows.

    Half of the units; all of them; all, with a late file in the first unit (its own events once more);
    and once more with nothing new. The newest unit is left open in each run.
    """
    work = work_dir(spark, "increments")
    rows, log = payloads(spark, sf_dir), f"{work}/log"
    marks = rows.agg(F.min("unit").alias("first"), F.max(F.col("unit").cast("bigint")).alias("last")).first()
    ensure_view(spark, f"{work}/epochs", EPOCH_TABLE, ("run_id",))
    half = F.col("unit").cast("bigint") <= marks["last"] // 2
    parts = []
    for run_id, more in enumerate((half, ~half, F.col("unit") == marks["first"], None), start=1):
        if more is not None:
            publish(rows.filter(more).repartition("unit"), log)
        run_batch_increment(spark, log, f"{work}/view", run_id, f"{work}/epochs", skip_open=True)
        events = decode_rows(read_events(spark, "text", log), fields=["item"])
        run_batch_view(events, f"{work}/full", run_id, skip_open=True)
    for name in ("view", "full"):
        parts.append(read_view(spark, f"{work}/{name}", BATCH_VIEW).select("run_id", "item", F.col("count").alias(name)))
    return parts[0].join(parts[1], ["run_id", "item"], "full").withColumnsRenamed({"view": "count", "full": "recomputed"})


def compacted_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per item in an archive that is compacted twice while it grows, and the most files of a compacted unit.

    The archive takes in half of the units, then the rest; the last unit stays open.
    """
    work = work_dir(spark, "compacted-archive")
    rows, log = payloads(spark, sf_dir), f"{work}/log"
    last = rows.agg(F.max("unit").alias("last")).first()["last"]
    half = F.pmod(F.col("unit").cast("bigint"), F.lit(2)) == 0
    for more in (half, ~half):
        publish_packed(rows.filter(more).repartition("unit"), f"{work}/topic")
        lines = read_topic(spark, f"{work}/topic")
        archive(lines, log, f"{work}/checkpoint", spread=4).awaitTermination()
        compact_archive(spark, log, last)
    files = topic_files(spark, f"{log}_compacted").filter("unit IS NOT NULL").groupBy("unit").count()
    most = files.agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).first()["n"]
    counts = count_by(decode_rows(read_archive_lines(spark, log), fields=["item"]))
    return counts.withColumn("most_files", F.lit(most).cast("bigint"))


def decoded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per item over payload text, parsing only the item."""
    rows = payloads(spark, sf_dir).select(
        F.from_json(F.col("value"), "item STRING").getField("item").alias("item")
    )
    return count_items(rows)


def latest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream that starts at the end of a topic counts, stopped and started again while the topic grows.

    A third of the units are there at the start. Later come another third, then, while the stream is
    down, the rest and a second file for the first unit (its own events once more).
    """
    work = work_dir(spark, "latest")
    rows = payloads(spark, sf_dir).withColumn("_part", F.pmod(F.col("unit").cast("bigint"), F.lit(3)))
    place = f"{work}/topic"

    def add(part: int) -> None:
        publish_packed(rows.filter(F.col("_part") == part), place)

    def drain() -> None:
        late = read_events(spark, PACKED, place, streaming=True, start="latest", start_record=f"{work}/start")
        snapshot_stream(late, f"{work}/view", f"{work}/checkpoint", trigger=DRAIN).awaitTermination()

    add(0)
    drain()
    add(1)
    drain()
    add(2)
    first = rows.agg(F.min("unit").alias("u")).scalar()
    publish_packed(rows.filter(F.col("unit") == first), place)
    drain()
    return latest_snapshot(read_view(spark, f"{work}/view", REALTIME_VIEW))


def empty_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream that started at the end of a topic before there was one."""
    work = work_dir(spark, "empty")

    def drain() -> None:
        late = read_events(spark, PACKED, f"{work}/topic", streaming=True, start="latest", start_record=f"{work}/start")
        snapshot_stream(late, f"{work}/view", f"{work}/checkpoint", trigger=DRAIN).awaitTermination()

    drain()
    publish_packed(payloads(spark, sf_dir), f"{work}/topic")
    drain()
    return current_snapshot(spark, f"{work}/view")


def compacted_history(spark: SparkSession, sf_dir: str, batches: int = 8) -> DataFrame:
    """Current counts and number of snapshots per item of live views in both modes, compacted twice while they grow."""
    parts = []
    for mode in ("complete", "update"):
        work = work_dir(spark, "compacted")
        view = f"{work}/view"
        write, events = write_snapshot(view, 0), topic(spark, sf_dir, f"{work}/topic", batches)

        def tidy_halfway(batch: DataFrame, batch_id: int, write=write, view=view, mode=mode) -> None:
            write(batch, batch_id)
            if batch_id == batches // 2:
                compact_history(spark, view, 0, mode)
                drop_compacted(spark, view, 0)

        snapshot_stream(
            events, view, f"{work}/checkpoint", trigger=DRAIN, mode=mode, callback=tidy_halfway
        ).awaitTermination()
        compact_history(spark, view, 0, mode)
        drop_compacted(spark, view, 0)
        snapshots = count_by(read_history(spark, view)).withColumnRenamed("count", "snapshots")
        now = current_snapshot(spark, view, mode=mode).join(snapshots, "item", "full")
        parts.append(now.select(F.lit(mode).alias("mode"), "item", "count", "snapshots"))
    return parts[0].unionByName(parts[1])


def released_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served totals of a live view whose state is let go, with the rows of that state at three times.

    Over half of the units; after a batch run over these is published; and over all units.
    """
    work = work_dir(spark, "release")
    layers, cuts = Layers(f"{work}/batch", f"{work}/realtime", f"{work}/epochs"), f"{work}/cuts"
    ensure_view(spark, layers.batch, BATCH_VIEW, ("run_id",))
    ensure_view(spark, layers.epochs, EPOCH_TABLE, ("run_id",))
    rows = payloads(spark, sf_dir)
    half = rows.select("unit").distinct().agg(F.expr("CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY CAST(unit AS BIGINT)) AS BIGINT)")).first()[0]
    state = []

    def add(wanted: Column) -> None:
        publish_packed(rows.filter(wanted), f"{work}/topic")

    def settle() -> None:
        query.processAllAvailable()
        state.append([p for p in query.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"])

    add(F.col("unit").cast("bigint") <= half)
    events = read_topic(spark, f"{work}/topic")
    query = snapshot_stream(
        events, layers.realtime, f"{work}/checkpoint", ["item", "unit"], trigger=AT_ONCE, mode="update", cuts=cuts
    )
    settle()
    batch = decode_rows(read_events(spark, PACKED, f"{work}/topic"), fields=["item"])
    run_batch_view(batch, layers.batch, 1, layers.epochs, skip_open=True)
    publish_cut(spark, layers.epochs, cuts, 1)
    settle()
    add(F.col("unit").cast("bigint") > half)
    settle()
    query.stop()
    totals = served_totals(spark, layers.batch, layers.realtime, layers.epochs, mode="update")
    names = ("state_before", "state_published", "state_after")
    return totals.select("*", *[F.lit(n).cast("bigint").alias(name) for name, n in zip(names, state, strict=True)])


def connector_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a view in a store that only appends, where the second micro-batch fails after its write and is run again.

    ``copies`` is the number of rows of an item that the store holds twice.
    """
    work = work_dir(spark, "connector")
    write, failed = write_snapshot(f"{work}/store", 0, fmt="json", mode="append"), []
    events = topic(spark, sf_dir, f"{work}/topic")

    def fail_once(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    run_until_ok(
        lambda: snapshot_stream(events, "", f"{work}/checkpoint", trigger=DRAIN, callback=fail_once), wait_s=0.1
    )
    held = read_view(spark, f"{work}/store", REALTIME_VIEW, "json")
    once = stored(appended_once(held), "store")
    copies = count_by(held).withColumnRenamed("count", "held").join(count_by(once), "item")
    return latest_snapshot(once).join(copies.select("item", (F.col("held") - F.col("count")).alias("copies")), "item")


def reader_agreement(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Events per item that the archive scan, the decoder and the live view count over the same lines."""
    work = work_dir(spark, "readers")
    publish(lines, f"{work}/topic")
    log = read_events(spark, "text", f"{work}/topic")
    live = read_events(spark, "text", f"{work}/topic", streaming=True)
    snapshot_stream(live, f"{work}/view", f"{work}/checkpoint", trigger=DRAIN).awaitTermination()
    found = {
        "archive": count_by(read_archive_json(spark, f"{work}/topic")),
        "decoded": count_by(decode_rows(log)),
        "live": latest_snapshot(read_view(spark, f"{work}/view", REALTIME_VIEW)),
    }
    named = [rows.select(F.lit(name).alias("reader"), "item", "count") for name, rows in found.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def restarted_by_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals served right before and after a restart by message, with and without a run in the message.

    The new epoch counts what the published run does not cover. It is served once it is made active.
    """
    parts = []
    for named in (True, False):
        layers = hand_off(spark, sf_dir)
        control = f"{layers.batch}_control"
        emit_restart(spark, control, 1 if named else None)

        def act(run_id: int | None, layers: Layers = layers, named: bool = named) -> None:
            epoch = rotate_epoch(spark, layers.realtime)
            waiting = served_totals(spark, layers.batch, layers.realtime, layers.epochs)
            waiting.write.parquet(f"{layers.batch}_waiting")
            rest = uncovered(
                stream_purchases(spark, sf_dir).select("item", "unit"), covered_units(spark, layers.epochs, run_id)
            )
            snapshot_stream(
                rest, layers.realtime, f"{layers.realtime}_checkpoint_{epoch}", ["item", "unit"], epoch, DRAIN
            ).awaitTermination()
            activate_epoch(spark, active_table(layers.realtime), epoch)

        messages = spark.readStream.text(control)
        on_restart(messages, act, f"{control}_checkpoint", DRAIN, layers.epochs).awaitTermination()
        after = served_totals(spark, layers.batch, layers.realtime, layers.epochs)
        for when, rows in (("waiting", spark.read.schema(after.schema).parquet(f"{layers.batch}_waiting")), ("active", after)):
            parts.append(rows.select(F.lit(named).alias("named"), F.lit(when).alias("epoch"), "item", "batch", "real", "total"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def served_with_null_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served totals where the events of some units have lost the name of their unit."""
    work = work_dir(spark, "null-units")
    layers = Layers(f"{work}/batch", f"{work}/realtime", f"{work}/epochs")
    ensure_view(spark, layers.batch, BATCH_VIEW, ("run_id",))
    ensure_view(spark, layers.epochs, EPOCH_TABLE, ("run_id",))
    unit = F.when(F.col("unit").cast("bigint") % 2 == 0, F.col("unit")).alias("unit")
    live = stream_purchases(spark, sf_dir).select("item", unit)
    snapshot_stream(live, layers.realtime, f"{work}/checkpoint", ["item", "unit"], trigger=DRAIN).awaitTermination()
    run_batch_view(purchases(spark, sf_dir).select("item", unit), layers.batch, 1, layers.epochs)
    return served_totals(spark, layers.batch, layers.realtime, layers.epochs)


def rows_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every micro-batch of a topic that is read file by file, as the queries report them.

    A micro-batch costs the driver about the same time however small it is, so the topic has lanes, each
    with a query of its own, and these run at the same time (``small_batches``).
    """
    work = work_dir(spark, "batch-sizes")
    publish(payloads(spark, sf_dir).repartition("unit"), f"{work}/topic", lanes=READ_LANES)
    with BatchWatch(spark) as watch:
        queries = []
        with small_batches(spark, work):
            for lane in range(READ_LANES):
                events = read_events(
                    spark, "text", lane_of(f"{work}/topic", lane), streaming=True, options={"maxFilesPerTrigger": "1"}
                )
                queries.append(
                    observed(events).writeStream.format("noop").option("checkpointLocation", f"{work}/checkpoint_{lane}")
                    .trigger(**DRAIN).start()
                )
        sizes = []
        for query in queries:
            query.awaitTermination()
            sizes.extend((b["rows"],) for b in watch.take(query) if b["rows"])
    return spark.createDataFrame(sizes, "rows BIGINT")


def paced_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a live view at its own pace, one micro-batch every two seconds, while a topic grows in four steps."""
    work = work_dir(spark, "paced")
    rows = payloads(spark, sf_dir)
    events = read_topic(spark, f"{work}/topic")
    query = snapshot_stream(events, f"{work}/view", f"{work}/checkpoint", ["item", "unit"], trigger=LIVE_TRIGGER)
    for step in range(4):
        publish_packed(rows.filter(F.pmod(F.col("unit").cast("bigint"), F.lit(4)) == step), f"{work}/topic")
        query.processAllAvailable()
    query.stop()
    return current_snapshot(spark, f"{work}/view")


def silent_live(spark: SparkSession, sf_dir: str, factor: float, steps: int = 4) -> DataFrame:
    """Silent machines by a stream of alarms, at the end of a topic that grows in time order.

    The stream is down while the topic grows, and goes on from its checkpoint behind each step.
    """
    work = work_dir(spark, "silent")
    bought = purchases(spark, sf_dir)
    profile = stored(gap_profile(bought), "profile")
    marks = bought.agg(F.max("time_stamp").alias("now"), F.max(F.col("unit").cast("bigint")).alias("last")).first()
    step = F.floor(F.col("unit").cast("bigint") * steps / (marks["last"] + 1))
    for number in range(steps):
        publish_packed(payloads(spark, sf_dir).filter(step == number), f"{work}/topic")
        live = decode_rows(read_topic(spark, f"{work}/topic"), fields=["snack_automat_id", "timestamp"])
        query = (
            silence_alarms(live.select(MACHINE, "time_stamp"), profile, factor).writeStream.format("parquet")
            .outputMode("append").option("checkpointLocation", f"{work}/checkpoint").trigger(**AT_ONCE).start(f"{work}/alarms")
        )
        query.processAllAvailable()
        query.stop()
    alarms = spark.read.parquet(f"{work}/alarms")
    return standing_alarms(alarms, profile, F.lit(marks["now"]))


def updated_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live totals of a view that is written in update mode, over several micro-batches."""
    work = work_dir(spark, "update")
    events = topic(spark, sf_dir, f"{work}/topic")
    snapshot_stream(
        events, f"{work}/view", f"{work}/checkpoint", trigger={"availableNow": True}, mode="update"
    ).awaitTermination()
    return latest_snapshot(read_view(spark, f"{work}/view", REALTIME_VIEW), mode="update")
