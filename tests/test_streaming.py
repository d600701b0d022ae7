import contextlib
import io
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyline.functions import decode_rows
from tallyline.operators import latest_snapshot, reconcile, serving_view, silence_alarms, standing_alarms
from tallyline.plans import items_sold, run_batch_increment, run_batch_view, served_totals
from tallyline.plans import flows
from tallyline.plans import layers as layers_module
from tallyline.schema import ACTIVE_EPOCHS, BATCH_VIEW, EPOCH_TABLE, RAW_VIEW, REALTIME_VIEW
from tallyline.sources.folders import exists
from tallyline.sources.tables import EVENTS_PER_UNIT
from tallyline.sources import ensure_view, offset_unit, read_events, read_view, topic_files
from tallyline.streaming import (
    BatchWatch, observed, unit_delays,
    activate_epoch, active_epoch, on_restart, restart_behind_run,
    append_raw_view, archive, batch_sizes, compact_history, covered_units, current_snapshot, drop_compacted, emit_restart,
    known_epochs, newest_batch, point_to, publish, publish_cut, read_history, replay, restart_signals,
    rotate_epoch, run_until_ok, snapshot_stream, write_snapshot,
)
from tallyline.streaming import compact_archive, compaction, read_archive_lines
from tallyline.streaming.epochs import uncovered
from tallyline.streaming.queries import AT_ONCE, BY_FILE_SYSTEM, DRAIN, FILE_MANAGER, LIVE_TRIGGER, LOG_DELAY, lane_of, small_batches
from tallyline.streaming.release import cut_of
from tallyline.session import LISTING_TASKS
from tests.helpers import payload, rows, write_unit

ONE_FILE = {"maxFilesPerTrigger": "1"}


@pytest.fixture
def topic(tmp_path):
    """Six units; the counts grow to a=12, b=6, with three rejects."""
    place = tmp_path / "topic"
    for unit in range(6):
        lines = [payload("a", price=1), payload("a", price=2), payload("b", price=3)]
        if unit < 3:
            lines.append("broken")
        write_unit(place, f"u{unit}", lines)
    return place


TOTALS = [("a", 12), ("b", 6)]


def stream(spark, topic, **more):
    return read_events(spark, "text", str(topic), streaming=True, options=ONE_FILE, **more)


def live(spark, path, keys=("item",), mode="complete"):
    return latest_snapshot(read_view(spark, path, REALTIME_VIEW), keys, mode)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_live_counts_equal_batch_counts(spark, topic, folder, mode):
    query = snapshot_stream(stream(spark, topic), f"{folder}/v", f"{folder}/c", trigger=DRAIN, mode=mode)
    query.awaitTermination()
    assert rows(live(spark, f"{folder}/v", mode=mode)) == TOTALS
    assert rows(items_sold(decode_rows(read_events(spark, "text", str(topic))))) == TOTALS
    batch_sizes(stream(spark, topic), f"{folder}/s", f"{folder}/sc").awaitTermination()
    sizes = spark.read.parquet(f"{folder}/s").orderBy("batch_id")
    assert sorted(r["rows"] for r in sizes.collect()) == [3, 3, 3, 4, 4, 4]


def test_history_holds_one_stamped_snapshot_per_batch(spark, topic, folder):
    snapshot_stream(stream(spark, topic), f"{folder}/v", f"{folder}/c", trigger=DRAIN).awaitTermination()
    view = read_view(spark, f"{folder}/v", REALTIME_VIEW)
    assert view.select("batch_id").distinct().count() == 6
    assert view.groupBy("batch_id").agg(F.count_distinct("time_stamp").alias("n")).filter("n <> 1").count() == 0
    assert view.filter("id IS NULL OR time_stamp IS NULL").count() == 0
    assert view.select("id").distinct().count() == view.count() == 12


def test_state_survives_a_failure_after_the_write(spark, topic, folder):
    write, seen = write_snapshot(f"{folder}/v", 0), []

    def fail_in_batch_one(batch, batch_id):
        seen.append(batch_id)
        write(batch, batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            write_unit(topic, "u6", [payload("c")])
            raise RuntimeError("lost")

    run_until_ok(
        lambda: snapshot_stream(
            stream(spark, topic), f"{folder}/v", f"{folder}/c", trigger=DRAIN, callback=fail_in_batch_one
        ),
        wait_s=0.0,
    )
    assert seen == [0, 1, 1, 2, 3, 4, 5, 6]
    assert rows(live(spark, f"{folder}/v")) == [*TOTALS, ("c", 1)]
    view = read_view(spark, f"{folder}/v", REALTIME_VIEW)
    assert view.groupBy("batch_id", "item").count().filter("count > 1").count() == 0


def test_retries_come_to_an_end(spark, topic, folder):
    def never(batch, batch_id):
        raise RuntimeError("always")

    starts = []

    def start():
        starts.append(1)
        return snapshot_stream(stream(spark, topic), "", f"{folder}/c", trigger=DRAIN, callback=never)

    with pytest.raises(StreamingQueryException):
        run_until_ok(start, retries=2, wait_s=0.0)
    assert len(starts) == 3


def test_replay_rebuilds_the_view(spark, topic, folder):
    for name in ("one", "two"):
        replay(stream(spark, topic), f"{folder}/{name}", f"{folder}/{name}-c").awaitTermination()
    assert rows(live(spark, f"{folder}/one")) == rows(live(spark, f"{folder}/two")) == TOTALS


def test_fan_out_and_archive(spark, topic, folder):
    source = stream(spark, topic)
    queries = [
        archive(source, f"{folder}/log", f"{folder}/log-c"),
        append_raw_view(source, f"{folder}/raw", f"{folder}/raw-c"),
        snapshot_stream(source, f"{folder}/v", f"{folder}/c", trigger=DRAIN),
    ]
    for query in queries:
        query.awaitTermination()
    log = read_events(spark, "text", f"{folder}/log")
    assert log.count() == 21
    assert rows(log) == rows(read_events(spark, "text", str(topic)))
    raw = read_view(spark, f"{folder}/raw", RAW_VIEW)
    assert raw.count() == raw.select("id").distinct().count() == 18
    assert rows(items_sold(raw)) == rows(live(spark, f"{folder}/v")) == TOTALS


def test_archive_goes_on_where_it_stopped(spark, topic, folder):
    for _ in range(2):
        archive(stream(spark, topic), f"{folder}/log", f"{folder}/c").awaitTermination()
    write_unit(topic, "u6", [payload("a")])
    archive(stream(spark, topic), f"{folder}/log", f"{folder}/c").awaitTermination()
    assert read_events(spark, "text", f"{folder}/log").count() == 22


def test_latest_start_skips_what_is_there_and_nothing_else(spark, topic, folder):
    def drain():
        late = stream(spark, topic, start="latest", start_record=f"{folder}/start")
        snapshot_stream(late, f"{folder}/v", f"{folder}/c", trigger=DRAIN).awaitTermination()
        return rows(live(spark, f"{folder}/v"))

    drain()
    write_unit(topic, "u6", [payload("z")])
    assert drain() == [("z", 1)]
    # While the query is down: a new unit, and more for the unit that was open at the start.
    write_unit(topic, "u7", [payload("z")])
    write_unit(topic, "u5", [payload("y")], "part-1.txt")
    assert drain() == [("y", 1), ("z", 2)]


def test_latest_start_of_flat_files(spark, tmp_path, folder):
    place = tmp_path / "flat"
    place.mkdir()
    (place / "x").write_text(payload("a") + "\n")

    def names():
        late = read_events(
            spark, "text", str(place), start="latest", unit="file", start_record=f"{folder}/start"
        )
        return rows(late, "unit")

    assert names() == []
    (place / "y").write_text(payload("a") + "\n")
    assert names() == [("y",)]
    with pytest.raises(ValueError):
        read_events(spark, "text", str(place), start="latest")


def test_files_of_the_past_are_not_opened_at_a_start(spark, topic, folder):
    place = str(topic)
    for unit in range(6):
        os.utime(topic / f"unit=u{unit}" / "part-0.txt", (1000 + unit, 1000 + unit))

    def drain(settle_s, few_names):
        name = f"{settle_s}-{few_names}"
        late = stream(spark, topic, start="latest", start_record=f"{folder}/s{name}", settle_s=settle_s, few_names=few_names)
        query = archive(late, f"{folder}/o{name}", f"{folder}/c{name}")
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress), query

    for settle_s, few_names, opened in ((0, 10, 0), (1, 10, 0), (0, 0, 3), (1, 0, 6), (100, 0, 21)):
        seen, query = drain(settle_s, few_names)
        # Names that are joined are read first; files below the recorded time never are.
        assert seen == opened
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            query.explain()
        assert "DataFilters: [(file_modification_time" in plan.getvalue()
    # Committed late: the file's time lies before the newest one's, but within the time to settle.
    write_unit(topic, "u3", [payload("y")], "part-1.txt")
    os.utime(topic / "unit=u3" / "part-1.txt", (1004, 1004))
    write_unit(topic, "u9", [payload("z")])
    for settle_s, few_names in ((1, 10), (1, 0), (100, 0)):
        drain(settle_s, few_names)
        got = read_events(spark, "text", f"{folder}/o{settle_s}-{few_names}")
        assert rows(got, "unit") == [("u3",), ("u9",)]


def test_a_start_that_broke_off_is_recorded_again(spark, topic, folder):
    def late():
        return read_events(spark, "text", str(topic), start="latest", start_record=f"{folder}/s").count()

    assert late() == 0
    os.remove(f"{folder}/s/_SUCCESS")
    write_unit(topic, "u7", [payload("a")])
    assert late() == 0


def test_a_missing_topic_is_empty_at_first(spark, tmp_path, folder):
    place = tmp_path / "none" / "yet"

    def drain(start):
        more = {"start_record": f"{folder}/s"} if start == "latest" else {}
        query = archive(stream(spark, place, start=start, **more), f"{folder}/{start}", f"{folder}/{start}-c")
        query.awaitTermination()

    for start in ("latest", "earliest"):
        drain(start)
    write_unit(place, "u1", [payload("a")])
    for start in ("latest", "earliest"):
        drain(start)
        assert read_events(spark, "text", f"{folder}/{start}").count() == 1


def test_files_as_units(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).write_text(payload("a") + "\n")
    got = read_events(spark, "text", str(tmp_path), unit="file")
    assert rows(got, "unit") == [("x",), ("y",)]


def test_publish_appends_to_a_topic(spark, folder):
    frame = spark.createDataFrame([(payload("a"), "u0"), (payload("b"), "u1")], "value STRING, unit STRING")
    publish(frame, f"{folder}/t")
    publish(frame, f"{folder}/t")
    assert read_events(spark, "text", f"{folder}/t").groupBy("unit").count().filter("count = 2").count() == 2


class Layers:
    def __init__(self, spark, topic, folder):
        self.spark, self.topic = spark, topic
        self.batch, self.live, self.epochs, self.folder = (
            f"{folder}/b", f"{folder}/v", f"{folder}/e", folder)
        ensure_view(spark, self.batch, BATCH_VIEW, ("run_id",))
        ensure_view(spark, self.epochs, EPOCH_TABLE, ("run_id",))
        self.active = f"{folder}/a"
        ensure_view(spark, self.active, ACTIVE_EPOCHS, ("epoch",))

    def drain(self, epoch=0, only_new=False):
        source = stream(self.spark, self.topic)
        if only_new:
            source = uncovered(source, covered_units(self.spark, self.epochs))
        snapshot_stream(
            source, self.live, f"{self.folder}/c{epoch}", ["item", "unit"], epoch, DRAIN
        ).awaitTermination()

    def run(self, run_id, before=None, skip_open=False):
        events = decode_rows(read_events(self.spark, "text", str(self.topic)), fields=["item"])
        return run_batch_view(events, self.batch, run_id, self.epochs, before=before, skip_open=skip_open)

    def served(self):
        return served_totals(self.spark, self.batch, self.live, self.epochs, active=self.active)

    def truth(self):
        return items_sold(decode_rows(read_events(self.spark, "text", str(self.topic))))

    def check(self):
        report = reconcile(self.served(), self.truth())
        assert report.filter("NOT ok").count() == 0
        return rows(report, "item", "batch", "real", "served")


def test_hand_off_is_exact_at_every_step(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    layers.drain()
    assert layers.check() == [("a", 0, 12, 12), ("b", 0, 6, 6)]
    layers.run(1, before="u2")
    assert layers.check() == [("a", 4, 8, 12), ("b", 2, 4, 6)]
    write_unit(topic, "u6", [payload("c"), payload("a")])
    layers.drain()
    assert layers.check() == [("a", 4, 9, 13), ("b", 2, 4, 6), ("c", 0, 1, 1)]
    layers.run(2, before="u6")
    assert layers.check() == [("a", 12, 1, 13), ("b", 6, 0, 6), ("c", 0, 1, 1)]
    layers.run(3, skip_open=True)
    assert layers.check() == [("a", 12, 1, 13), ("b", 6, 0, 6), ("c", 0, 1, 1)]
    layers.run(4)
    assert layers.check() == [("a", 13, 0, 13), ("b", 6, 0, 6), ("c", 1, 0, 1)]


def test_repeated_run_replaces_itself(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    for _ in range(2):
        assert rows(layers.run(1), "item", "count") == TOTALS
    assert covered_units(spark, layers.epochs).count() == 6


def test_new_epoch_starts_at_zero_behind_the_cut(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    layers.drain()
    layers.run(1, before="u4")
    epoch = rotate_epoch(spark, layers.live)
    assert epoch == 1
    assert rows(live(spark, layers.live)) == [("a", 0), ("b", 0)]
    assert layers.check() == [("a", 8, 4, 12), ("b", 4, 2, 6)]
    write_unit(topic, "u6", [payload("a")])
    layers.drain(epoch, only_new=True)
    activate_epoch(spark, layers.active, epoch)
    assert layers.check() == [("a", 8, 5, 13), ("b", 4, 2, 6)]
    per_item = live(spark, layers.live, ["item", "unit"]).groupBy("item").agg(F.sum("count"))
    assert rows(per_item) == [("a", 5), ("b", 2)]


def test_difference_is_reported(spark):
    batch = spark.createDataFrame([("a", 3)], "item STRING, count BIGINT")
    none = spark.createDataFrame([], "item STRING, unit STRING, count BIGINT")
    truth = spark.createDataFrame([("a", 5), ("b", 1)], "item STRING, count BIGINT")
    got = reconcile(serving_view(batch, none, none), truth)
    assert rows(got, "item", "served", "truth", "diff", "ok") == [
        ("a", 3, 5, -2, False), ("b", 0, 1, -1, False)]


def test_restart_messages(spark, folder):
    emit_restart(spark, f"{folder}/control", 7)
    other = spark.createDataFrame([('{"restart":"False","run_id":8}',), ("noise",)], "value STRING")
    got = restart_signals(spark.read.text(f"{folder}/control").unionByName(other))
    assert rows(got) == [(7,)]
    assert spark.read.text(f"{folder}/control").first()["value"].startswith('{"restart":"True"')


def test_restart_message_restarts_the_live_view(spark, topic, folder):
    def start(epoch):
        return snapshot_stream(
            stream(spark, topic, start="latest", start_record=f"{folder}/s{epoch}") if epoch else stream(spark, topic),
            f"{folder}/v", f"{folder}/c{epoch}", epoch=epoch, trigger=DRAIN,
        )

    first = start(0)
    first.awaitTermination()
    runs, restarted = [], []

    def act(run_id):
        runs.append(run_id)
        restarted.append(restart_behind_run(first, start, f"{folder}/v"))

    for run_id in (3, 4):
        emit_restart(spark, f"{folder}/control", run_id)
    messages = spark.readStream.text(f"{folder}/control")
    on_restart(messages, act, f"{folder}/control-c", DRAIN).awaitTermination()
    restarted[0].awaitTermination()
    assert runs == [4]
    assert rows(live(spark, f"{folder}/v")) == [("a", 0), ("b", 0)]


def test_connector_writes_repeat_the_same_ids(spark, folder):
    batch = spark.createDataFrame([("a", 2), ("b", 3)], "item STRING, count BIGINT")
    write = write_snapshot(f"{folder}/store", 5, fmt="json", mode="append")
    write(batch, 1)
    write(batch, 1)
    write(batch, 2)
    stored_rows = spark.read.json(f"{folder}/store")
    assert stored_rows.count() == 6
    assert stored_rows.select("id").distinct().count() == 4


def test_open_units_of_a_partitioned_log_are_left_out(spark, folder):
    log = spark.range(10).selectExpr("'a' AS item", "'t' AS topic", "CAST(id % 2 AS INT) AS partition", "id DIV 2 AS offset")
    events = log.select("item", offset_unit("partition", "offset", 2).alias("unit"))
    run = run_batch_view(events, f"{folder}/b", 1, f"{folder}/e", skip_open=True)
    # Each partition has offsets 0 to 4, so two full runs and an open one.
    assert rows(run, "item", "count") == [("a", 8)]
    assert rows(covered_units(spark, f"{folder}/e"), "unit") == [
        (f"t:{p:05d}:{r:012d}",) for p in range(2) for r in range(2)]


def test_epochs_can_be_made_active_again(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    layers.drain()
    assert active_epoch(spark, layers.active, layers.live) == 0
    for epoch in (1, 2, 1):
        activate_epoch(spark, layers.active, epoch)
        assert active_epoch(spark, layers.active) == epoch


def test_a_new_epoch_is_not_served_before_it_is_active(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    layers.drain()
    layers.run(1, before="u2")
    before = layers.check()
    rotate_epoch(spark, layers.live)
    got = served_totals(spark, layers.batch, layers.live, layers.epochs)
    assert rows(got, "item", "batch", "real", "total") == before


def test_null_units_are_counted_once(spark, folder):
    events = spark.createDataFrame([("a", None), ("a", "u1"), ("b", None)], "item STRING, unit STRING")
    run_batch_view(events, f"{folder}/b", 1, f"{folder}/e")
    live_counts = events.groupBy("item", "unit").count()
    done = spark.read.parquet(f"{folder}/b").select("item", "count")
    got = serving_view(done, live_counts, covered_units(spark, f"{folder}/e"))
    assert rows(got, "item", "batch", "real", "total") == [("a", 2, 0, 2), ("b", 1, 0, 1)]
    assert uncovered(events, covered_units(spark, f"{folder}/e")).count() == 0


def test_a_run_without_rows_replaces_an_earlier_try(spark, folder):
    events = spark.createDataFrame([("a", "u1")], "item STRING, unit STRING")
    assert run_batch_view(events, f"{folder}/b", 1, f"{folder}/e").count() == 1
    assert run_batch_view(events.limit(0), f"{folder}/b", 1, f"{folder}/e").count() == 0
    assert covered_units(spark, f"{folder}/e", 1).count() == 0


def test_plain_restart_message_acts_on_the_newest_run(spark, topic, folder):
    layers = Layers(spark, topic, folder)
    layers.run(1, before="u2")
    layers.run(2, before="u4")
    emit_restart(spark, f"{folder}/control")
    assert spark.read.text(f"{folder}/control").first()["value"] == '{"restart":"True"}'
    seen = []
    messages = spark.readStream.text(f"{folder}/control")
    on_restart(messages, seen.append, f"{folder}/cc", DRAIN, layers.epochs).awaitTermination()
    assert seen == [2]


def test_snapshot_of_a_view_by_unit_adds_the_units(spark):
    view = spark.createDataFrame(
        [("a", "u1", 3, 0, 1), ("a", "u2", 4, 0, 1)], "item STRING, unit STRING, count BIGINT, epoch BIGINT, batch_id BIGINT"
    )
    assert rows(latest_snapshot(view)) == [("a", 7)]


def test_pointer_opens_two_folders_of_a_long_history(spark, folder):
    view = f"{folder}/v"
    snapshots = spark.range(1000).selectExpr(
        "explode(array('a', 'b')) AS item", "CAST(NULL AS STRING) AS unit", "id + 1 AS count",
        "timestamp_seconds(id) AS time_stamp", "uuid() AS id_", "0L AS epoch", "id AS batch_id",
    ).withColumnRenamed("id_", "id")
    snapshots.repartition(8, "batch_id").write.partitionBy("epoch", "batch_id").parquet(view)
    assert not known_epochs(spark, view)
    want = rows(live(spark, view))
    assert rows(current_snapshot(spark, view)) == want == [("a", 1000), ("b", 1000)]
    point_to(spark, view, 0, 999)
    point_to(spark, view, 0, 3)  # an old batch, run again
    assert newest_batch(spark, view, 0) == 999
    opened = current_snapshot(spark, view)
    assert rows(opened) == want and len(opened.inputFiles()) == 1
    rotated = rotate_epoch(spark, view)
    assert rotated == 1 and rows(current_snapshot(spark, view)) == [("a", 0), ("b", 0)]
    assert rows(current_snapshot(spark, view, epoch=0)) == want

    before = rows(read_history(spark, view, 0))
    assert len(before) == 2000
    assert compact_history(spark, view, 0, rows_per_file=500) == 998
    assert rows(read_history(spark, view, 0)) == before
    assert drop_compacted(spark, view, 0) == 999
    assert rows(read_history(spark, view, 0)) == before and rows(current_snapshot(spark, view, epoch=0)) == want
    assert len(read_history(spark, view, 0).inputFiles()) <= 5
    assert compact_history(spark, view, 0) == 998 and drop_compacted(spark, view, 0) == 0


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_compaction_in_steps_keeps_every_answer(spark, topic, folder, mode):
    view, write, seen = f"{folder}/v", write_snapshot(f"{folder}/v", 0), []

    def tidy(batch, batch_id):
        write(batch, batch_id)
        compact_history(spark, view, 0, mode, max_segments=2)
        if batch_id % 2:
            drop_compacted(spark, view, 0)
        seen.append(rows(current_snapshot(spark, view, mode=mode)))

    write_unit(topic, "u9", [payload("z")])
    snapshot_stream(stream(spark, topic), view, f"{folder}/c", trigger=DRAIN, mode=mode, callback=tidy).awaitTermination()
    assert len(seen) == 7 and seen[-1] == [*TOTALS, ("z", 1)]
    history = read_history(spark, view)
    assert history.groupBy("batch_id", "item").count().filter("count > 1").count() == 0
    assert rows(latest_snapshot(history, mode=mode)) == seen[-1]
    plain = f"{folder}/plain"
    snapshot_stream(stream(spark, topic), plain, f"{folder}/pc", trigger=DRAIN, mode=mode).awaitTermination()
    assert rows(history, "item", "count", "batch_id") == rows(read_view(spark, plain, REALTIME_VIEW), "item", "count", "batch_id")
    # All but the newest batch are compacted, in at most three folders.
    assert len([f for f in history.inputFiles() if "_segments" in f]) <= 3


def test_state_of_published_units_is_let_go(spark, tmp_path, folder):
    place, view, epochs, cuts = tmp_path / "t", f"{folder}/v", f"{folder}/e", f"{folder}/cuts"
    ensure_view(spark, f"{folder}/b", BATCH_VIEW, ("run_id",))
    ensure_view(spark, epochs, EPOCH_TABLE, ("run_id",))

    def start():
        source = read_events(spark, "text", str(place), streaming=True)
        return snapshot_stream(source, view, f"{folder}/c", ["item", "unit"], trigger=AT_ONCE, mode="update", cuts=cuts)

    def state():
        query.processAllAvailable()
        return [p for p in query.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"]

    def totals():
        got = served_totals(spark, f"{folder}/b", view, epochs, active=f"{folder}/a", mode="update")
        return rows(got, "item", "batch", "real", "total")

    for unit in range(4):
        write_unit(place, f"u{unit}", [payload("a"), payload("b")])
    query = start()
    assert state() == 8 and totals() == [("a", 0, 4, 4), ("b", 0, 4, 4)]
    run_batch_view(decode_rows(read_events(spark, "text", str(place)), fields=["item"]), f"{folder}/b", 1, epochs, skip_open=True)
    publish_cut(spark, epochs, cuts, 1)
    assert state() == 2 and totals() == [("a", 3, 1, 4), ("b", 3, 1, 4)]
    write_unit(place, "u1", [payload("a")], "late.txt")  # its unit is closed
    write_unit(place, "u4", [payload("a")])
    write_unit(place, "u3", [payload("c")], "more.txt")
    assert state() == 4 and totals() == [("a", 3, 2, 5), ("b", 3, 1, 4), ("c", 0, 1, 1)]
    query.stop()
    query.awaitTermination()
    query = start()
    write_unit(place, "u5", [payload("a")])
    assert state() == 5 and totals() == [("a", 3, 3, 6), ("b", 3, 1, 4), ("c", 0, 1, 1)]
    query.stop()
    with pytest.raises(ValueError):
        snapshot_stream(read_events(spark, "text", str(place), streaming=True), view, f"{folder}/x", cuts=cuts)


def test_a_cut_is_the_lowest_of_all_sources(spark):
    units = spark.createDataFrame([("t:0:7",), ("t:0:8",), ("t:1:5",), ("t:1:4",)], "unit STRING")
    assert rows(cut_of(units).select(F.unix_seconds("cut"))) == [(6,)]
    assert cut_of(units.limit(0)).count() == cut_of(spark.createDataFrame([("x",)], "unit STRING")).count() == 0


def test_batches_are_watched_without_a_job_of_their_own(spark, topic, folder):
    source = observed(stream(spark, topic), longest=F.max(F.length("value")))
    with BatchWatch(spark) as watch:
        query = archive(source, f"{folder}/log", f"{folder}/c")
        query.awaitTermination()
        seen = watch.take(query)
    assert [b["batch_id"] for b in seen] == list(range(6))
    assert sorted(b["rows"] for b in seen) == [3, 3, 3, 4, 4, 4]
    assert {b["longest"] for b in seen} == {len(payload("a", price=1))} and all(b["trigger_ms"] >= 0 for b in seen)
    assert watch.take(query) == []


def test_delay_of_the_live_view_at_its_own_pace(spark, tmp_path, folder):
    place, view = tmp_path / "t", f"{folder}/v"
    source = read_events(spark, "text", str(place), streaming=True)
    query = snapshot_stream(source, view, f"{folder}/c", ["item", "unit"], trigger=LIVE_TRIGGER)
    for unit in range(6):
        write_unit(place, f"u:{unit}", [payload("a"), payload("b")])
        time.sleep(1.0)
    query.processAllAvailable()
    query.stop()
    starts = [p["timestamp"][17:23] for p in query.recentProgress if p["numInputRows"]]
    # Micro-batches begin on the even seconds, but behind one that took longer.
    assert len(starts) >= 2 and any(float(s) % 2 < 0.2 for s in starts[1:])
    files = topic_files(spark, str(place))
    assert rows(files, "unit") == [(f"u:{unit}",) for unit in range(6)]
    delays = [r["delay_ms"] for r in unit_delays(read_history(spark, view), files).collect()]
    print("delays in ms", sorted(delays))
    assert len(delays) == 6 and 0 <= min(delays) and max(delays) < 30_000


def test_alarms_of_silent_machines(spark, tmp_path, folder):
    def at(minute):
        return f"2024-08-01 {minute // 60:02d}:{minute % 60:02d}:00"

    # The gap is 10 minutes: m1 falls silent once, at 30, and comes back at 70; m2 goes on; m3 is new.
    sold = {"u1": [("m1", 0), ("m2", 0), ("m1", 10), ("m2", 25), ("m1", 30)], "u2": [("m2", 50), ("m3", 55), ("m1", 70), ("m2", 75)],
            "u3": [("m2", 100), ("m2", 125), (None, 126)]}
    profile = spark.createDataFrame([("m1", 10.0), ("m2", 25.0), (None, 1.0)], "snack_automat_id STRING, mean_gap_us DOUBLE").withColumn(
        "mean_gap_us", F.col("mean_gap_us") * 60_000_000)
    place = tmp_path / "t"
    for unit in sold:
        write_unit(place, unit, [])
    for unit, lines in sold.items():
        write_unit(place, unit, [payload("a", snack_automat_id=m, timestamp=at(t)) for m, t in lines], "p.txt")
        events = decode_rows(read_events(spark, "text", str(place), streaming=True))
        query = silence_alarms(events, profile, 1.5).writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", f"{folder}/c").trigger(**DRAIN).start(f"{folder}/alarms")
        query.awaitTermination()
    got = spark.read.parquet(f"{folder}/alarms")
    assert rows(got.select("snack_automat_id", F.date_format("last_seen", "HH:mm"), "sold")) == [("m1", "00:10", 2), ("m1", "00:30", 1), ("m1", "01:10", 1)]
    # The two gaps of m1 that are longer than 15 minutes, and its silence at the end.
    seen = spark.createDataFrame([("m1", 4, "2024-08-01 01:10:00"), ("m2", 6, "2024-08-01 02:05:00")], "snack_automat_id STRING, sold INT, t STRING")
    profile = seen.select("snack_automat_id", "sold", F.to_timestamp("t").alias("last_seen"), F.lit(1.0).alias("mean_gap_us"))
    standing = standing_alarms(got, profile, F.lit("2024-08-01 02:06:00").cast("timestamp"))
    assert rows(standing, "snack_automat_id", "silence_us") == [("m1", 56 * 60_000_000)]


def test_increments_equal_full_runs_and_read_changed_units_alone(spark, topic, folder, monkeypatch):
    read, place = [], str(topic)
    real = layers_module.decode_rows
    monkeypatch.setattr(layers_module, "decode_rows", lambda log, fields: read.append(log) or real(log, fields=fields))
    ensure_view(spark, f"{folder}/e", EPOCH_TABLE, ("run_id",))

    def run(run_id, **more):
        got = rows(run_batch_increment(spark, place, f"{folder}/b", run_id, f"{folder}/e", **more), "item", "count")
        events = decode_rows(read_events(spark, "text", place), fields=["item"])
        full = run_batch_view(events, f"{folder}/f", run_id, skip_open=more.get("skip_open", False))
        assert got == rows(full, "item", "count")
        return sorted({r["unit"] for r in read[-1].select("unit").collect()}, key=str), got

    assert run(1, skip_open=True) == ([f"u{i}" for i in range(6)], [("a", 10), ("b", 5)])
    write_unit(topic, "u6", [payload("c")])
    assert run(2, skip_open=True)[0] == ["u5", "u6"]
    write_unit(topic, "u1", [payload("z")], "late.txt")
    # A run that is done again, by filter or by join, gives the same.
    for more in ({}, {"few_units": 0}, {"settle_s": 0}):
        units, got = run(3, **more)
        assert units == ["u1", "u6"] and got == [("a", 12), ("b", 6), ("c", 1), ("z", 1)]
    write_unit(topic, "u:7%+ x", [payload("a")])
    write_unit(topic, "__HIVE_DEFAULT_PARTITION__", [payload("a")])
    units, got = run(4)
    assert got == [("a", 14), ("b", 6), ("c", 1), ("z", 1)]
    assert run(5) == ([], got)


def test_compaction_of_an_archive_shows_each_line_once(spark, topic, folder, monkeypatch):
    log, spots = f"{folder}/log", []

    def grow():
        archive(stream(spark, topic), log, f"{folder}/c", spread=2).awaitTermination()

    def lines():
        got = rows(read_archive_lines(spark, log))
        assert got == rows(read_events(spark, "text", log))
        return len(got)

    real = compaction.replace_text
    # Right before and behind the switch, and with a file that comes while a compaction is on its way.
    def switch(spark_, path, text):
        write_unit(topic, "u2", [payload("x")], f"while-{len(spots)}.txt")
        grow()
        spots.append(lines())
        real(spark_, path, text)
        spots.append(lines())

    monkeypatch.setattr(compaction, "replace_text", switch)
    grow()
    assert lines() == 21
    assert compact_archive(spark, log, "u4") == 1 and spots == [22, 22]
    write_unit(topic, "u0", [payload("late")], "late.txt")
    write_unit(topic, "u8", [payload("a")] * 40)
    write_unit(topic, "__HIVE_DEFAULT_PARTITION__", [payload("n")])
    grow()
    assert lines() == 64 and rows(read_archive_lines(spark, log, few_names=0)) == rows(read_events(spark, "text", log))
    # Small parts would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert compact_archive(spark, log, "u9", target_bytes=200) == 2 and spots[2:] == [65, 65]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert lines() == 65 and compact_archive(spark, log, "u9") == 3 and compact_archive(spark, log, "u9") == 4
    # A unit's files follow its bytes: 40 lines of 12 bytes in files of 200.
    files = topic_files(spark, f"{log}_compacted").filter("unit IS NOT NULL")
    found = {r["unit"]: r["count"] for r in files.filter("file LIKE '%000002%'").groupBy("unit").count().collect()}
    # Two of the three parts may meet in one task.
    assert found.pop("u8") in (2, 3) and found == {"u0": 1, "u2": 1, "u4": 1, "u5": 1}


def test_lanes_hold_whole_units_and_each_once(spark, folder):
    place = f"{folder}/t"
    frame = spark.createDataFrame([(f"v{i}", None if i % 7 == 0 else f"u{i % 7}") for i in range(70)], "value STRING, unit STRING")
    publish(frame.repartition("unit"), place, lanes=3)
    lanes = [read_events(spark, "text", lane_of(place, n), streaming=False) for n in range(3) if exists(spark, lane_of(place, n))]
    assert rows(lanes[0].unionByName(lanes[1]) if len(lanes) == 2 else lanes[0].unionByName(lanes[1]).unionByName(lanes[2])) == rows(frame)
    units = [u for lane in lanes for u in rows(lane.select("unit").distinct())]
    assert len(units) == len(set(units)) == 7


def test_more_batches_are_reported_than_a_query_keeps_by_itself(spark, topic, folder):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for kept in (1_000, 4):
            with BatchWatch(spark, kept) as watch:
                query = archive(observed(stream(spark, topic)), f"{folder}/log{kept}", f"{folder}/c{kept}")
                query.awaitTermination()
            assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
            if kept > 6:
                assert [b["batch_id"] for b in watch.take(query)] == list(range(6))
            else:
                with pytest.raises(RuntimeError):
                    watch.take(query)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def file_manager(query):
    return query._jsq.streamingQuery().offsetLog().fileManager().getClass().getName()


def test_rows_per_batch_checkpoints_start_no_process_to_rename(spark, tmp_path, monkeypatch):
    # 23 units, one of them a row, with a hole in the numbers and one event twice.
    ids = [n for n in range(11_001) if not 700 <= n < 800] + [5]
    rest = ["timestamp_ntz'2024-01-01 00:00:00' AS ts", "1L AS user_id", "'a' AS event_type", "1D AS value", "'{\"k\": 1}' AS props"]
    events = spark.createDataFrame([(n,) for n in ids], "event_id BIGINT").selectExpr("event_id", *rest)
    events.write.parquet(f"{tmp_path}/events.parquet")
    seen = []

    class Watch(BatchWatch):
        def take(self, query, wait_s=60.0):
            seen.append(query)
            return super().take(query, wait_s)

    monkeypatch.setattr(flows, "BatchWatch", Watch)
    names = [FILE_MANAGER, LOG_DELAY, "spark.sql.adaptive.enabled", "spark.sql.ui.explainMode"]
    before = [spark.conf.get(name, None) for name in names]
    assert rows(flows.rows_per_batch(spark, str(tmp_path))) == [(1,), (400,), *[(500,)] * 20, (501,)]
    assert [spark.conf.get(name, None) for name in names] == before
    assert len(seen) == flows.READ_LANES and {file_manager(query) for query in seen} == {BY_FILE_SYSTEM}


def test_small_batches_leave_other_stores_and_settings_alone(spark, topic, folder):
    own = "org.apache.spark.sql.execution.streaming.checkpointing.FileContextBasedCheckpointFileManager"

    def run(name):
        query = observed(stream(spark, topic)).writeStream.format("noop").option("checkpointLocation", f"{folder}/{name}")
        return query.trigger(**DRAIN).start()

    with pytest.raises(RuntimeError), small_batches(spark, folder):
        assert spark.conf.get(FILE_MANAGER) == BY_FILE_SYSTEM
        raise RuntimeError("lost at the start")
    assert spark.conf.get(FILE_MANAGER, None) is None
    spark.conf.set(FILE_MANAGER, own)
    try:
        with BatchWatch(spark) as watch, small_batches(spark, folder):
            query = run("c")
        assert sorted(b["rows"] for b in watch.take(query)) == [3, 3, 3, 4, 4, 4] and file_manager(query) == own
        assert spark.conf.get(FILE_MANAGER) == own
    finally:
        spark.conf.unset(FILE_MANAGER)
    # Stopped and started again, a query goes on from the checkpoint that the other way has written.
    write_unit(topic, "u6", [payload("c")])
    with BatchWatch(spark) as watch, small_batches(spark, folder):
        query = run("c")
    assert [(b["batch_id"], b["rows"]) for b in watch.take(query)] == [(6, 1)] and file_manager(query) == BY_FILE_SYSTEM


def listing_tasks(spark, name, act):
    """Tasks of the largest stage of the jobs that ``act`` runs."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        act()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    infos = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
    return max(i.numTasks for i in infos if i is not None)


def test_folders_of_many_units_are_listed_in_few_tasks(spark, tmp_path):
    for unit in range(LISTING_TASKS + 20):
        write_unit(tmp_path / "t", f"u{unit}", [payload("a")])
    place = str(tmp_path / "t")
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert 1 < listing_tasks(spark, "listed-rows", lambda: read_events(spark, "text", place)) <= LISTING_TASKS
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert 1 < listing_tasks(spark, "listed-files", lambda: topic_files(spark, place)) <= LISTING_TASKS
    assert read_events(spark, "text", place).count() == LISTING_TASKS + 20


@pytest.mark.parametrize("units,batches,files,per_batch", [(0, 4, None, 1), (5, 8, None, 1), (512, 8, None, 64), (513, 8, 16, 2), (1200, 8, 24, 3), (72000, 8, 1128, 141)])
def test_files_of_a_topic_of_many_units(units, batches, files, per_batch):
    assert flows.files_of(units, batches) == (files, per_batch)
    # As many micro-batches as with a file for each unit.
    if files is not None:
        assert files // per_batch == -(-units // -(-units // batches)) and files < units


def test_a_packed_topic_reads_like_one_with_a_folder_for_each_unit(spark, folder):
    frame = spark.createDataFrame([("v1", "u1"), ("v2", "u2"), ("v3", None)] * 2, "value STRING, unit STRING")
    publish(frame.coalesce(1), f"{folder}/p", "parquet", packed=True)
    publish(frame, f"{folder}/f", "parquet")
    assert rows(read_events(spark, "parquet", f"{folder}/p")) == rows(read_events(spark, "parquet", f"{folder}/f")) == rows(frame)
    assert topic_files(spark, f"{folder}/p").count() == 1
    for wrong in ({}, {"fmt": "parquet", "lanes": 2}):
        with pytest.raises(ValueError):
            publish(frame, f"{folder}/w", packed=True, **wrong)


@pytest.fixture(scope="module")
def many_units(spark, tmp_path_factory):
    """A table of 600 events, each in a unit of its own."""
    place = str(tmp_path_factory.mktemp("many"))
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("view", "click", "error")]), (F.col("id") % 3 + 1).cast("int"))
    made = spark.range(600).select(
        (F.col("id") * EVENTS_PER_UNIT).alias("event_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), kinds.alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    made.coalesce(1).write.parquet(f"{place}/events.parquet")
    return place


@pytest.mark.parametrize("query", ["paced_totals", "released_state", "latest_start", "compacted_history"])
def test_a_topic_of_many_small_units_has_few_files(spark, many_units, monkeypatch, query):
    places, real = set(), flows.publish

    def watched(rows, location, *args, **more):
        real(rows, location, *args, **more)
        places.add(location)

    monkeypatch.setattr(flows, "publish", watched)
    got = getattr(flows, query)(spark, many_units)
    if query == "compacted_history":
        assert rows(got) == sorted((m, k, 200, 8) for m in ("complete", "update") for k in ("view", "click", "error"))
    elif query == "released_state":
        assert rows(got, "state_before", "state_published", "state_after") == [(300, 1, 301)] * 3
    else:
        # Of the first third nothing is counted but the first unit once more.
        assert {r["item"]: r["count"] for r in got.collect()} == (
            dict.fromkeys(("view", "click", "error"), 200) if query == "paced_totals" else {"view": 1, "click": 200, "error": 200}
        )
    assert places and all(topic_files(spark, place).count() < 60 for place in places)


def test_the_archive_keeps_together_what_one_task_reads_of_a_unit(spark, folder):
    frame = spark.createDataFrame([(f"v{i}", f"u{i % 3}") for i in range(90)], "value STRING, unit STRING")
    publish(frame.repartition("unit"), f"{folder}/t", "parquet", packed=True)
    lines = read_events(spark, "parquet", f"{folder}/t", streaming=True)
    archive(lines, f"{folder}/log", f"{folder}/c", spread=4).awaitTermination()
    assert rows(read_events(spark, "text", f"{folder}/log")) == rows(frame)
    assert topic_files(spark, f"{folder}/log").count() == 3
