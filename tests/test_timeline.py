from decimal import Decimal
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyline.operators import (
    count_by, delay_series, gap, in_tie, interval_sum, intervals, positional_slice, running_total,
    tie_rank, timeline,
)
from tests.helpers import rows

# A recorded run; minute:second on 2024-08-02 from 09:00, events in that second.
EVENTS = [
    ("47:39", 2), ("47:43", 1), ("47:47", 3), ("47:51", 2), ("47:55", 3), ("47:59", 4), ("48:03", 3),
    ("48:07", 7), ("48:11", 3), ("48:15", 4), ("48:19", 5), ("48:23", 7), ("48:27", 2), ("48:31", 6),
    ("48:35", 2), ("48:39", 4), ("48:43", 5), ("48:47", 1), ("48:51", 3), ("48:55", 3), ("48:59", 3),
    ("49:03", 2), ("49:07", 4), ("49:11", 1), ("49:15", 1), ("49:19", 2), ("49:23", 5),
]
# Snapshots of that run; count, minute:second.
SNAPSHOTS = [
    (2, "47:40.161"), (3, "47:44.830"), (6, "47:48.693"), (8, "47:52.383"), (11, "47:55.865"),
    (15, "48:00.110"), (18, "48:04.102"), (25, "48:08.103"), (28, "48:12.100"), (32, "48:16.090"),
    (37, "48:20.108"), (44, "48:24.090"), (46, "48:28.084"), (52, "48:32.088"), (54, "48:36.096"),
    (58, "48:40.090"), (63, "48:44.083"), (64, "48:48.088"), (67, "48:52.087"), (70, "48:56.091"),
    (73, "49:00.098"), (75, "49:04.089"), (79, "49:08.078"), (80, "49:12.084"), (81, "49:16.093"),
    (83, "49:20.077"), (88, "49:24.078"),
]
# N-th event, milliseconds until a snapshot shows n.
DELAYS = {2: 1160, 3: 1830, 6: 1691, 8: 1382, 11: 863, 15: 1107, 18: 1100, 25: 1097, 88: 1074}


def at(text):
    return datetime.fromisoformat(f"2024-08-02 09:{text}")


@pytest.fixture(scope="module")
def events(spark):
    made = [("banana", at(t), f"{t}/{i}") for t, n in EVENTS for i in range(n)]
    return spark.createDataFrame(made, "item STRING, time_stamp TIMESTAMP, id STRING")


@pytest.fixture(scope="module")
def snapshots(spark):
    return spark.createDataFrame(
        [("banana", n, at(t)) for n, t in SNAPSHOTS], "item STRING, count BIGINT, time_stamp TIMESTAMP"
    )


def test_totals_and_ties(events):
    assert rows(count_by(events)) == [("banana", 88)]
    totals = running_total(events)
    assert sorted(r["cumulated"] for r in totals.collect()) == list(range(1, 89))
    assert in_tie(events).filter("in_tie").count() == 84
    assert tie_rank(events).agg(F.max("tie_rank")).first()[0] == 6


@pytest.mark.parametrize("limit", [1000, 20, 5], ids=["whole", "periods", "ranges"])
def test_delay_series(events, snapshots, limit):
    got = delay_series(events, snapshots, max_group_rows=limit).collect()
    delays = {r["cumulated"]: round((r["time_y"] - r["time_x"]) / timedelta(milliseconds=1))
              for r in got if r["delay"] is not None}
    assert len(got) == 88 and len(delays) == 27
    assert DELAYS.items() <= delays.items()
    assert min(delays.values()) == 863 and max(delays.values()) == 1830
    assert sum(delays.values()) / 27 == pytest.approx(1143.6296, abs=1e-4)


def test_delay_keeps_every_snapshot(spark, events):
    shown = spark.createDataFrame(
        [("banana", 2, at("50:00")), ("banana", 2, at("50:01")), ("banana", 0, at("47:00")), ("tea", 1, at("50:00"))],
        "item STRING, count BIGINT, time_stamp TIMESTAMP",
    )
    got = delay_series(events, shown)
    assert got.count() == 87 + 4
    assert got.filter("time_x IS NULL").count() == 2
    assert got.filter("delay IS NOT NULL").count() == 2


def test_gap(snapshots):
    got = [r["gap"] for r in gap(snapshots).orderBy("time_stamp").collect()]
    millis = [round(g / timedelta(milliseconds=1)) for g in got[1:]]
    assert got[0] is None and len(millis) == 26
    assert (min(millis), median(millis), max(millis)) == (3482, 3998, 4669)


def test_stream_totals_equal_the_events_at_every_snapshot(events, snapshots):
    taken = [r["time_stamp"] for r in events.collect()]
    for row in snapshots.collect():
        assert sum(t <= row["time_stamp"] for t in taken) == row["count"]


def make(spark, made):
    return spark.createDataFrame(
        [(item, START + timedelta(seconds=s), n) for item, s, n in made],
        "item STRING, time_stamp TIMESTAMP, count BIGINT",
    )


START = datetime(2024, 1, 1)
FORMS = [(True, 1000), (False, 1000), (False, 3)]


@pytest.mark.parametrize("bins, limit", FORMS)
def test_interval_sum(spark, bins, limit):
    bounds = make(spark, [("a", 0, 1), ("a", 10, 5), ("a", 20, 9), ("a", 33, 12), ("b", 5, 100), ("b", 25, 200)])
    reads = make(spark, [
        ("a", -1, 50), ("a", 0, 2), ("a", 9, 3), ("a", 10, 4), ("a", 32, 6), ("a", 33, 70),
        ("b", 4, 1), ("b", 5, 7), ("b", 24, 8), ("c", 6, 9),
    ])
    got = [(i, (t - START).seconds, n) for i, t, n in rows(
        interval_sum(bounds, reads, max_group_rows=limit, broadcast_bins=bins))]
    # The second interval of "a" starts at 10 and holds one reading; the one before holds two.
    assert got == [("a", 10, 6), ("a", 20, 9), ("a", 33, 15), ("b", 25, 115)]


@pytest.mark.parametrize("bins, limit", FORMS)
def test_interval_sum_with_equal_bounds_and_hot_moment(spark, bins, limit):
    bounds = make(spark, [("a", 0, 1), ("a", 10, 5), ("a", 10, 6), ("a", 30, 9)])
    reads = make(spark, [("a", 10, 1)] * 40 + [("a", 3, 1)])
    got = [((t - START).seconds, n) for _, t, n in rows(
        interval_sum(bounds, reads, max_group_rows=limit, broadcast_bins=bins))]
    assert got == [(10, 2), (10, 5), (30, 46)]


def test_crowded_intervals_are_not_broadcast(spark):
    crowd = make(spark, [("a", i / 1000, i) for i in range(300)] + [("a", 10_000_000, 1)])
    with pytest.raises(ValueError, match="uneven"):
        interval_sum(crowd, crowd, broadcast_bins=True)
    assert interval_sum(crowd, crowd).count() == 300


def test_last_bound_opens_no_interval(spark):
    got = intervals(make(spark, [("a", 0, 1), ("a", 4, 2), ("b", 0, 1)]))
    assert [(r["item"], (r["end"] - r["start"]).seconds) for r in got.collect()] == [("a", 4)]


def test_positional_slice(spark):
    frame = make(spark, [("a", s, s) for s in range(10)] + [("b", 3, 3)])
    order = ["time_stamp", "count"]
    assert rows(positional_slice(frame, ["item"], order, 2, 5), "count") == [(2,), (3,), (4,)]
    assert rows(positional_slice(frame, ["item"], order, 8, 2000), "count") == [(8,), (9,)]
    assert rows(positional_slice(frame, [], order, 3, 6), "item", "count") == [("a", 3), ("a", 4), ("b", 3)]
    plan = positional_slice(frame, [], order, 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan


def test_interval_sums_keep_fractions_in_both_forms(spark):
    bounds = make(spark, [("a", 0, 10), ("a", 10, 20), ("a", 20, 30)])
    for kind, half in (("DOUBLE", 0.5), ("DECIMAL(18,2)", Decimal("0.50"))):
        readings = make(spark, [("a", s, 1) for s in (1, 2, 3, 4)]).withColumn("count", F.lit(half).cast(kind))
        for form in (True, False):
            got = interval_sum(bounds, readings, broadcast_bins=form)
            assert [float(v) for (v,) in rows(got, "cumulated")] == [12.0, 20.0]


def test_delays_of_null_keys_are_kept(spark):
    events = make(spark, [("a", 1, 1), (None, 2, 1)]).withColumn("id", F.lit("x")).drop("count")
    shown = make(spark, [(None, 5, 1)])
    for most in (1, 1_000_000):
        got = delay_series(events, shown, max_group_rows=most)
        assert got.count() == 2
        assert got.filter("item IS NULL AND time_x IS NOT NULL AND time_y IS NOT NULL").count() == 1


def test_timeline_fills_missing_columns(spark):
    one = make(spark, [("a", 0, 1)])
    both = timeline((one, "all_data"), (one.drop("count"), "batch"))
    assert rows(both, "category", "count") == [("all_data", 1), ("batch", None)]


def test_one_series_without_a_key(spark, events, snapshots):
    per_item = delay_series(events, snapshots).select("cumulated", "delay")
    overall = delay_series(events.drop("item"), snapshots.drop("item"), keys=[]).select("cumulated", "delay")
    assert sorted(map(str, overall.collect())) == sorted(map(str, per_item.collect()))
    bounds = make(spark, [("a", 0, 1), ("a", 10, 5), ("a", 20, 9)]).drop("item")
    reads = make(spark, [("a", 3, 2), ("a", 12, 4)]).drop("item")
    for bins in (True, False):
        got = interval_sum(bounds, reads, keys=[], broadcast_bins=bins)
        assert [n for _, n in rows(got)] == [3, 9]


@pytest.mark.parametrize("keys", [["item"], []], ids=["by item", "overall"])
@pytest.mark.parametrize("limit", [10_000, 20])
def test_slices_equal_numbered_rows(spark, keys, limit):
    begin = datetime(2024, 8, 2)
    made = [
        (["a", "hot", None][i % 3 if i % 2 else 1], None if i % 17 == 0 else begin + timedelta(minutes=(i * 37 % 500) // 90 * 90), f"{i:04d}")
        for i in range(400)
    ]
    frame = spark.createDataFrame(made, "item STRING, time_stamp TIMESTAMP, id STRING")
    order = lambda r: (r[1] is not None, r[1] or begin, r[2])
    # Moments hold dozens of rows: places begin and end within ties, and among rows without a time.
    for lo, hi in ((0, 5), (3, 30), (20, 21), (60, 140), (0, 1000), (390, 395), (500, 600), (7, 7)):
        want = []
        for key in ({r[0] for r in made} if keys else {0}):
            want += sorted((r for r in made if not keys or r[0] == key), key=order)[lo:hi]
        got = positional_slice(frame, keys, ["time_stamp", "id"], lo, hi, limit)
        assert got.columns == frame.columns
        assert rows(got, "id") == sorted((r[2],) for r in want)


def test_a_slice_reads_its_periods_alone(spark, tmp_path):
    place = str(tmp_path / "t")
    frame = spark.range(20_000).selectExpr("CAST(id % 3 AS STRING) AS item", "timestamp_seconds(id * 60) AS time_stamp", "CAST(id AS STRING) AS id")
    frame.write.parquet(place)
    for keys in (["item"], []):
        got = positional_slice(spark.read.parquet(place), keys, ["time_stamp", "id"], 4000, 4064)
        plan = got._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if f"[file:{place}]" in line)
        assert "GreaterThanOrEqual(time_stamp" in scan and "LessThan(time_stamp" in scan
        # Every exchange of rows lies above the filter; the rows that pass it are a few periods.
        near = got.agg(F.min("time_stamp"), F.max("time_stamp")).first()
        assert got.count() == 64 * (3 if keys else 1)
        assert near[1] - near[0] < timedelta(hours=4)


def test_interval_sums_of_a_null_key(spark):
    begin = datetime(2024, 8, 2)
    bounds = spark.createDataFrame(
        [(k, begin + timedelta(hours=h), n) for k in ("a", None) for h, n in ((0, 1), (2, 10))],
        "item STRING, time_stamp TIMESTAMP, count BIGINT",
    )
    readings = spark.createDataFrame([(k, begin + timedelta(hours=1), 3) for k in ("a", None)], bounds.schema)
    for bins in (True, False):
        got = rows(interval_sum(bounds, readings, broadcast_bins=bins), "item", "cumulated")
        assert got == [(None, 4), ("a", 4)]
