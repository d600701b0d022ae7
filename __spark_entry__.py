"""Registered queries over the given tables, with the SQL they are checked against."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyline import operators as ops  # noqa: E402
from tallyline.functions import classify, encode, enrich, health_label, micros_of, parse_any_time, price_of  # noqa: E402
from tallyline.operators.merge import latest_by_time, reconcile  # noqa: E402
from tallyline.plans import flows  # noqa: E402
from tallyline.plans.history import period_counts, snapshot_history  # noqa: E402
from tallyline.plans.layers import served_totals  # noqa: E402
from tallyline.plans.totals import items_sold, items_sold_live  # noqa: E402
from tallyline.schema import CSV_STREAM_ONLY_EVENTS  # noqa: E402
from tallyline.session import stored, work_dir  # noqa: E402
from tallyline.sources import purchases, read_archive_json, read_csv_view  # noqa: E402
from tallyline.sources.tables import EVENTS_PER_UNIT  # noqa: E402
from tallyline.streaming.control import encode_restart, restart_signals  # noqa: E402

RUN_CUTS = ("000000000001", "000000000010", None)
CAPACITY = 40
REVENUE_FLOOR = 5000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return purchases(spark, sf_dir)


def _plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    kinds = {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(kinds) if kinds else df


def _hourly(events: DataFrame) -> DataFrame:
    return events.withColumn("time_stamp", F.date_trunc("hour", "time_stamp"))


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# -- counts and layers ---------------------------------------------------------------------


def count_per_item_batch(spark, d):
    return items_sold(_events(spark, d))


def count_per_item_stream(spark, d):
    _events(spark, d)
    return items_sold_live(spark, flows.topic(spark, d, work_dir(spark, "topic")))


def decoded_count(spark, d):
    _events(spark, d)
    return flows.decoded_counts(spark, d)


def archive_scan_count(spark, d):
    _events(spark, d)
    return items_sold(read_archive_json(spark, flows.archive_log(spark, d)))


def compacted_archive(spark, d):
    _events(spark, d)
    return flows.compacted_archive(spark, d)


def archive_roundtrip(spark, d):
    _events(spark, d)
    return _plain_time(_money(flows.archived_events(spark, d), "price"))


def validation_view(spark, d):
    _events(spark, d)
    return _plain_time(_money(flows.validation_view(spark, d), "price"))


def encode_payload(spark, d):
    return encode(_events(spark, d), keep=("id",))


def malformed_rejects(spark, d):
    text = F.col("value")
    # The event types of the table and the labels below. Each event type but one gets its own kind of damage.
    broken = (
        F.when(F.col("item") == "error", F.substring(text, F.lit(1), F.length(text) - 1))
        .when(F.col("item") == "signup", F.regexp_replace(text, '"item":"signup",', ""))
        .when(F.col("item") == "click", F.regexp_replace(text, '"item":"click"', '"item":""'))
        .when(F.col("item") == "view", F.regexp_replace(text, r'"price":[0-9.]+', '"price":"abc"'))
        .otherwise(text)
    )
    lines = encode(_events(spark, d), keep=("item",)).select(broken.alias("value"))
    outcome = F.coalesce("reason", F.concat(F.lit("accepted "), "item"))
    priced = F.count(F.when(F.col("reason").isNull(), F.col("price")))
    return classify(lines, fields=["price"]).groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), priced.alias("priced")
    )


def batch_view_runs(spark, d):
    _events(spark, d)
    return flows.batch_runs(spark, d, RUN_CUTS)


def batch_view_increments(spark, d):
    _events(spark, d)
    return flows.incremental_runs(spark, d)


def _served(spark, d):
    layers = flows.hand_off(spark, d)
    return served_totals(spark, layers.batch, layers.realtime, layers.epochs)


def serving_merge(spark, d):
    _events(spark, d)
    return _served(spark, d)


def reconciliation(spark, d):
    events = _events(spark, d)
    return reconcile(_served(spark, d), items_sold(events))


def epoch_reset(spark, d):
    _events(spark, d)
    return flows.epoch_change(spark, d)


def restart_recovery(spark, d):
    _events(spark, d)
    return flows.recovered_totals(spark, d)


def replay(spark, d):
    _events(spark, d)
    return flows.replayed_totals(spark, d)


def fan_out(spark, d):
    _events(spark, d)
    return flows.fan_out(spark, d)


def control_signals(spark, d):
    events = _events(spark, d)
    runs = events.select(
        F.col("unit").cast("bigint").alias("run_id")
    ).distinct()
    topic = encode(events).unionByName(encode_restart(runs))
    return restart_signals(topic)


def latest_start(spark, d):
    _events(spark, d)
    return flows.latest_start(spark, d)


def empty_start(spark, d):
    _events(spark, d)
    return flows.empty_start(spark, d)


def compacted_history(spark, d):
    _events(spark, d)
    return flows.compacted_history(spark, d)


def released_state(spark, d):
    _events(spark, d)
    return flows.released_state(spark, d)


def connector_append(spark, d):
    _events(spark, d)
    return flows.connector_append(spark, d)


def lenient_times(spark, d):
    # Nine ways to write a time, dealt over the events by their number.
    shapes = (
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
        "yyyy-MM-dd HH:mm:ss'+02:00'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'-0530'", "dd/MM/yyyy HH:mm",
    )
    texts = F.array(*[F.date_format("time_stamp", shape) for shape in shapes])
    events = _events(spark, d).select("id", F.element_at(texts, (F.col("id").cast("int") % len(shapes)) + 1).alias("text"))
    return _plain_time(events.select("id", "text", parse_any_time("text").alias("time_stamp")))


def reader_agreement(spark, d):
    text = F.col("value")
    # Lines that readers may take in different ways: arrays, and a field that occurs twice.
    odd = (
        F.when(F.col("item") == "error", F.concat(F.lit("["), text, F.lit("]")))
        .when(F.col("item") == "signup", F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")))
        .when(F.col("item") == "click", F.regexp_replace(text, "^[{]", '{"item":"",'))
        .otherwise(text)
    )
    lines = encode(_events(spark, d), keep=("item", "unit")).select(odd.alias("value"), "unit")
    return flows.reader_agreement(spark, lines)


def restart_on_message(spark, d):
    _events(spark, d)
    return flows.restarted_by_message(spark, d)


def serving_null_units(spark, d):
    _events(spark, d)
    return flows.served_with_null_units(spark, d)


def batch_sizes(spark, d):
    _events(spark, d)
    return flows.rows_per_batch(spark, d)


def count_per_item_update(spark, d):
    _events(spark, d)
    return flows.updated_totals(spark, d)


def latest_snapshot(spark, d):
    return latest_by_time(snapshot_history(_events(spark, d), "hour"))


def csv_view(spark, d):
    path = work_dir(spark, "csv")
    # Fixed layout of the headerless export.
    order = ["id", "customer_id", "healthy_food", "item", "price", "snack_automat_id", "time_stamp"]
    _events(spark, d).select(*order).write.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return _plain_time(_money(read_csv_view(spark, path, CSV_STREAM_ONLY_EVENTS), "price"))


# -- timelines -----------------------------------------------------------------------------


def running_total(spark, d):
    totals = ops.running_total(_events(spark, d).select("item", "time_stamp", "id"))
    return _plain_time(totals)


def running_total_overall(spark, d):
    totals = ops.running_total(_events(spark, d).select("item", "time_stamp", "id"), keys=[])
    return _plain_time(totals)


def tie_spread(spark, d):
    rows = _hourly(_events(spark, d).select("item", "time_stamp", "id"))
    return _plain_time(ops.spread_ties(rows))


def tie_mask(spark, d):
    rows = _hourly(_events(spark, d).select("item", "time_stamp", "id"))
    marked = ops.in_tie(rows)
    return marked.select("id", "item", "in_tie")


def event_gap(spark, d):
    rows = ops.gap(_events(spark, d).select("item", "time_stamp", "id"), tie=["id"])
    since = rows.withColumn("earlier", F.col("time_stamp") - F.col("gap"))
    return since.select("id", "item", (micros_of("time_stamp") - micros_of("earlier")).alias("gap_us"))


def snapshot_gap(spark, d):
    rows = ops.gap(snapshot_history(_events(spark, d), "hour"), max_group_rows=None)
    since = rows.withColumn("earlier", F.col("time_stamp") - F.col("gap"))
    return _plain_time(since.select(
        "item", "time_stamp", "count", (micros_of("time_stamp") - micros_of("earlier")).alias("gap_us")
    ))


def positional_slice(spark, d):
    rows = _events(spark, d).select("item", "time_stamp", "id")
    return _plain_time(ops.positional_slice(rows, ["item"], ["time_stamp", "id"], 2, 66))


def row_position(spark, d):
    rows = _events(spark, d).select("item", "time_stamp", "id")
    return ops.row_position(rows, [], ["time_stamp", "id"]).select("id", "position")


def running_total_periods(spark, d):
    rows = _events(spark, d).select("item", "time_stamp", "id", "price")
    # Far below the rows of an item, so that each is cut into periods of time.
    totals = ops.running_total(rows, weight=F.col("price"), max_group_rows=100)
    return _plain_time(_money(totals.drop("price"), "cumulated"))


def row_position_ranges(spark, d):
    rows = _events(spark, d).select("item", F.date_trunc("day", "time_stamp").alias("time_stamp"), "id")
    # A day is one moment here, with more rows than may come together, so the order is cut into ranges.
    limit = max(5, rows.count() // 200)
    return ops.row_position(rows, ["item"], ["time_stamp", "id"], max_group_rows=limit).select("id", "position")


def interval_combined(spark, d):
    events = _events(spark, d)
    # The history of daily batch runs, and the live counts of each hour in between.
    return _plain_time(ops.interval_sum(snapshot_history(events, "day"), period_counts(events, "hour")))


def interval_events(spark, d):
    events = _events(spark, d)
    single = events.select("item", "time_stamp", F.lit(1).cast("bigint").alias("count"))
    return _plain_time(ops.interval_sum(snapshot_history(events, "day"), single))


def delay_series(spark, d):
    events = _hourly(_events(spark, d).select("item", "time_stamp", "id"))
    rows = ops.delay_series(events, stored(snapshot_history(events, "hour"), "history"))
    return _plain_time(rows.select(
        "item", "cumulated", "time_x", "time_y",
        (micros_of("time_y") - micros_of("time_x")).alias("delay_us"),
    ))


def interval_scan(spark, d):
    events = _events(spark, d)
    return _plain_time(ops.interval_sum(
        snapshot_history(events, "day"), period_counts(events, "hour"), broadcast_bins=False
    ))


def interval_money(spark, d):
    events = _events(spark, d)
    prices = events.select("item", "time_stamp", "price")
    forms = [
        _money(ops.interval_sum(snapshot_history(events, "day"), prices, value="price", broadcast_bins=bins), "cumulated")
        .withColumnRenamed("cumulated", name)
        for name, bins in (("by_scan", False), ("by_bins", True))
    ]
    return _plain_time(forms[0].join(forms[1], ["item", "time_stamp"], "full"))


def interval_null_items(spark, d):
    lost = F.nullif("item", F.lit("error")).alias("item")
    events = _events(spark, d).select(lost, "time_stamp", "id")
    history, hours = stored(snapshot_history(events, "day"), "history"), stored(period_counts(events, "hour"), "hours")
    forms = [
        ops.interval_sum(history, hours, broadcast_bins=bins).select(F.lit(name).alias("form"), "*")
        for name, bins in (("scan", False), ("bins", True))
    ]
    return _plain_time(forms[0].unionByName(forms[1]))


def delay_null_items(spark, d):
    lost = F.nullif("item", F.lit("error")).alias("item")
    events = _hourly(_events(spark, d).select(lost, "time_stamp", "id"))
    rows = ops.delay_series(events, stored(snapshot_history(events, "hour"), "history"))
    return _plain_time(rows.select(
        "item", "cumulated", "time_x", "time_y",
        (micros_of("time_y") - micros_of("time_x")).alias("delay_us"),
    ))


def slice_overall(spark, d):
    rows = _events(spark, d).select("item", "time_stamp", "id")
    return _plain_time(ops.positional_slice(rows, [], ["time_stamp", "id"], 300, 1800))


def timeline_union(spark, d):
    events = _events(spark, d).select("item", "time_stamp", "id")
    batch = stored(snapshot_history(events, "day"), "history")
    hours = period_counts(events, "hour")
    return _plain_time(ops.timeline(
        (ops.running_total(events).drop("id"), "all_data"),
        (batch.withColumnRenamed("count", "cumulated"), "HadoopResults"),
        (hours.withColumnRenamed("count", "cumulated"), "SparkResults"),
        (ops.interval_sum(batch, hours), "SparkResults+HadoopResults"),
    ))


# -- enrichment and questions --------------------------------------------------------------


def enrich_catalogue(spark, d):
    number = F.regexp_extract("snack_automat_id", r"(\d+)$", 1).cast("int")
    slots = _events(spark, d).select(
        "id", F.concat(F.lit("position_"), (number % 10 + 1).cast("string")).alias("item")
    )
    rows = enrich(slots).withColumn("price_by_name", price_of(F.col("snack")))
    return _money(rows, "price", "price_by_name")


def healthy_label(spark, d):
    number = F.regexp_extract("snack_automat_id", r"(\d+)$", 1).cast("int")
    slots = _events(spark, d).select(F.concat(F.lit("position_"), (number % 10 + 1).cast("string")).alias("item"))
    return slots.groupBy(health_label(F.col("item")).alias("healthy_food")).agg(F.count(F.lit(1)).alias("count"))


def unprofitable_machines(spark, d):
    return _money(ops.unprofitable_machines(_events(spark, d), REVENUE_FLOOR), "revenue")


def top_machines(spark, d):
    return _money(ops.top_machines(_events(spark, d), 10), "revenue")


def healthy_share(spark, d):
    return _money(ops.healthy_share(_events(spark, d)), "revenue")


def stockout_risk(spark, d):
    return ops.stockout_risk(_events(spark, d), CAPACITY, "72 hours")


def silent_machines(spark, d):
    return _plain_time(ops.silent_machines(_events(spark, d), 3.0))


def silent_machines_live(spark, d):
    _events(spark, d)
    return _plain_time(flows.silent_live(spark, d, 3.0))


def paced_totals(spark, d):
    _events(spark, d)
    return flows.paced_totals(spark, d)


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    count_per_item_batch, count_per_item_stream, decoded_count, archive_scan_count,
    archive_roundtrip, validation_view, encode_payload, malformed_rejects, batch_view_runs,
    serving_merge, reconciliation, epoch_reset, restart_recovery, replay, fan_out,
    control_signals, latest_snapshot, csv_view, running_total, running_total_overall, tie_spread,
    tie_mask, event_gap, snapshot_gap, positional_slice, row_position, interval_combined,
    interval_events, delay_series, timeline_union, enrich_catalogue, healthy_label,
    unprofitable_machines, top_machines, healthy_share, stockout_risk, silent_machines,
    interval_scan, interval_money, delay_null_items, slice_overall, latest_start, reader_agreement,
    restart_on_message, serving_null_units, batch_sizes, count_per_item_update,
    empty_start, compacted_history, released_state, running_total_periods, row_position_ranges,
    connector_append, lenient_times, interval_null_items, silent_machines_live, paced_totals,
    batch_view_increments, compacted_archive,
)


def entry(spark: SparkSession) -> DataFrame:
    """How many articles of each type were sold in total?"""
    return count_per_item_batch(spark, "/root/testdata/sf0.001")


def _importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this folder on the path of Spark's Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent))
        return query(spark, sf_dir)

    return run


def _pipeline_entries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where these, or what they need, cannot be imported."""
    try:
        import corpus_pipeline
        from tallyline.llm.entries import ORACLES, QUERIES
    except ImportError as error:
        if error.name not in ("corpus_pipeline", "tallyline.llm", "tallyline.llm.entries"):
            print(f"the training-data queries are left out: {error}", file=sys.stderr)
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    found = QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _importable(query) for name, query in found.items()}, ORACLES | sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | _pipeline_entries()[0]


# -- SQL -----------------------------------------------------------------------------------

_P = f"""P AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_type AS item, user_id AS customer_id,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'healthy' ELSE 'not_healthy' END AS healthy_food,
         CAST(value AS DECIMAL(18,2)) AS price,
         'SNACK--' || json_extract_string(props, '$.k') AS snack_automat_id,
         ts AS time_stamp, printf('%012d', event_id // {EVENTS_PER_UNIT}) AS unit
  FROM events)"""
# The same where the items of one type are lost.
_LOST = _P.replace("event_type AS item", "nullif(event_type, 'error') AS item")
_COUNT = "SELECT event_type AS item, count(*) AS count FROM events GROUP BY 1"
_ROW = "id, item, customer_id, healthy_food, CAST(price AS DOUBLE) AS price, snack_automat_id, time_stamp"
_HOURS = """hours AS (
  SELECT item, date_trunc('hour', time_stamp) + INTERVAL 1 HOUR AS time_stamp, count(*) AS count
  FROM P GROUP BY 1, 2)"""


def _history(period: str) -> str:
    return f"""{period}_history AS (
  SELECT item, time_stamp, CAST(sum(n) OVER (PARTITION BY item ORDER BY time_stamp) AS BIGINT) AS count
  FROM (SELECT item, date_trunc('{period}', time_stamp) + INTERVAL 1 {period} AS time_stamp, count(*) AS n
        FROM P GROUP BY 1, 2))"""


_SPANS = """spans AS (
  SELECT item, time_stamp AS s, e, count AS base FROM (
    SELECT *, lead(time_stamp) OVER (PARTITION BY item ORDER BY time_stamp) AS e FROM day_history)
  WHERE e IS NOT NULL)"""
_COMBINED = """SELECT spans.item AS item, e AS time_stamp,
       CAST(any_value(base) + coalesce(sum(r.count), 0) AS BIGINT) AS cumulated
FROM spans LEFT JOIN {readings} r ON r.item = spans.item AND r.time_stamp >= s AND r.time_stamp < e
GROUP BY spans.item, s, e"""
_SLOT = "'position_' || (CAST(json_extract_string(props, '$.k') AS INT) % 10 + 1)"


def oracle_sql() -> dict[str, str]:
    open_unit = "(SELECT max(unit) FROM P)"
    served = f"""served AS (
  SELECT item, count(*) FILTER (unit < {open_unit}) AS batch, count(*) FILTER (unit = {open_unit}) AS real
  FROM P GROUP BY item)"""
    runs = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS run_id, item, count(*) AS count FROM P"
        + (f" WHERE unit < '{cut}'" if cut else "") + " GROUP BY item"
        for i, cut in enumerate(RUN_CUTS, start=1)
    )
    return _pipeline_entries()[1] | {
        "count_per_item_batch": _COUNT,
        "count_per_item_stream": _COUNT,
        "decoded_count": _COUNT,
        "archive_scan_count": _COUNT,
        "archive_roundtrip": f"WITH {_P} SELECT {_ROW}, unit FROM P",
        "compacted_archive": "SELECT event_type AS item, count(*) AS count, CAST(1 AS BIGINT) AS most_files FROM events GROUP BY 1",
        "validation_view": f"WITH {_P} SELECT {_ROW}, unit FROM P",
        "encode_payload": f"""WITH {_P}
SELECT id, '{{"id":"' || id || '","item":"' || item || '","customer_id":' || customer_id
       || ',"healthy_food":"' || healthy_food || '","price":' || price
       || ',"snack_automat_id":"' || snack_automat_id
       || '","timestamp":"' || strftime(time_stamp, '%Y-%m-%d %H:%M:%S.%f') || '"}}' AS value
FROM P""",
        "malformed_rejects": """
SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing item'
       WHEN 'click' THEN 'empty item' ELSE 'accepted ' || event_type END AS outcome,
       count(*) AS rows, count(*) FILTER (event_type = 'purchase') AS priced
FROM events GROUP BY 1""",
        "batch_view_runs": f"WITH {_P} {runs}",
        "batch_view_increments": f"""WITH {_P}, U AS (SELECT max(CAST(unit AS BIGINT)) AS last FROM P),
N AS (SELECT item, CAST(unit AS BIGINT) AS u, count(*) AS n FROM P GROUP BY 1, 2),
R AS (
  SELECT 1 AS run_id, item, n FROM N, U WHERE u < last // 2
  UNION ALL SELECT r.run_id, item, n FROM N, U, (VALUES (2), (3), (4)) AS r(run_id) WHERE u < last
  UNION ALL SELECT r.run_id, item, n FROM N, (VALUES (3), (4)) AS r(run_id) WHERE u = 0),
S AS (SELECT CAST(run_id AS BIGINT) AS run_id, item, CAST(sum(n) AS BIGINT) AS count FROM R GROUP BY 1, 2)
SELECT *, count AS recomputed FROM S""",
        "serving_merge": f"WITH {_P}, {served} SELECT item, batch, real, batch + real AS total FROM served",
        "reconciliation": f"""WITH {_P}, {served}
SELECT item, batch, real, batch + real AS served, (SELECT count(*) FROM P t WHERE t.item = s.item) AS truth,
       CAST(0 AS BIGINT) AS diff, true AS ok
FROM served s""",
        "epoch_reset": f"""WITH {_P}
SELECT item, count(*) AS count, CAST(0 AS BIGINT) AS epoch FROM P GROUP BY item
UNION ALL
SELECT item, count(*) FILTER (unit = {open_unit}) AS count, CAST(1 AS BIGINT) AS epoch FROM P GROUP BY item""",
        "restart_recovery": _COUNT,
        "replay": "SELECT event_type AS item, count(*) AS first, count(*) AS replayed FROM events GROUP BY 1",
        "fan_out": """
SELECT c.consumer AS consumer, (SELECT count(*) FROM events) AS rows
FROM (VALUES ('archive'), ('validation'), ('live')) AS c(consumer)""",
        "control_signals": f"SELECT DISTINCT event_id // {EVENTS_PER_UNIT} AS run_id FROM events",
        "latest_snapshot": _COUNT,
        "csv_view": f"WITH {_P} SELECT {_ROW} FROM P",
        "running_total": f"""WITH {_P}
SELECT item, time_stamp, id, row_number() OVER (PARTITION BY item ORDER BY time_stamp, id) AS cumulated FROM P""",
        "running_total_overall": f"""WITH {_P}
SELECT item, time_stamp, id, row_number() OVER (ORDER BY time_stamp, id) AS cumulated FROM P""",
        "interval_scan": f"""WITH {_P}, {_history('day')}, {_HOURS}, {_SPANS}
{_COMBINED.format(readings='hours')}""",
        "interval_money": f"""WITH {_P}, {_history('day')}, {_SPANS}, S AS (
SELECT spans.item AS item, e AS time_stamp, CAST(any_value(base) + coalesce(sum(r.price), 0) AS DOUBLE) AS by_scan
FROM spans LEFT JOIN P r ON r.item = spans.item AND r.time_stamp >= s AND r.time_stamp < e
GROUP BY spans.item, s, e)
SELECT *, by_scan AS by_bins FROM S""",
        "slice_overall": f"""WITH {_P}
SELECT item, time_stamp, id FROM P QUALIFY row_number() OVER (ORDER BY time_stamp, id) BETWEEN 301 AND 1800""",
        "latest_start": f"""WITH {_P}
SELECT item, count(*) FILTER (CAST(unit AS BIGINT) % 3 <> 0) + count(*) FILTER (unit = (SELECT min(unit) FROM P)) AS count
FROM P GROUP BY item""",
        "empty_start": _COUNT,
        # In update mode an item's snapshots are the batches with events of it; every unit has some of each.
        "compacted_history": f"""WITH {_P}, U AS (SELECT count(DISTINCT unit) AS units FROM P),
B AS (SELECT CAST(ceil(units / ceil(units / 8)) AS BIGINT) AS snapshots FROM U)
SELECT m.mode AS mode, item, count(*) AS count, any_value(snapshots) AS snapshots
FROM P, B, (VALUES ('complete'), ('update')) AS m(mode) GROUP BY 1, 2""",
        "released_state": f"""WITH {_P},
H AS (SELECT quantile_disc(u, 0.5) AS half FROM (SELECT DISTINCT CAST(unit AS BIGINT) AS u FROM P)),
K AS (SELECT DISTINCT item, CAST(unit AS BIGINT) AS u, half FROM P, H)
SELECT item, count(*) FILTER (CAST(unit AS BIGINT) < half) AS batch, count(*) FILTER (CAST(unit AS BIGINT) >= half) AS real,
       count(*) AS total, (SELECT count(*) FROM K WHERE u <= half) AS state_before,
       (SELECT count(*) FROM K WHERE u = half) AS state_published, (SELECT count(*) FROM K WHERE u >= half) AS state_after
FROM P, H GROUP BY item""",
        "connector_append": "SELECT event_type AS item, count(*) AS count, CAST(1 AS BIGINT) AS copies FROM events GROUP BY 1",
        "lenient_times": f"""WITH {_P}, S AS (SELECT id, time_stamp AS t, CAST(id AS BIGINT) % 9 AS k, date_trunc('second', time_stamp) AS s FROM P)
SELECT id, CASE k WHEN 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(t, '%Y-%m-%d %H:%M:%S.%f')
         WHEN 2 THEN strftime(t, '%Y-%m-%dT%H:%M:%S') WHEN 3 THEN strftime(t, '%Y-%m-%d %H:%M') WHEN 4 THEN strftime(t, '%Y-%m-%d')
         WHEN 5 THEN strftime(t, '%Y-%m-%d %H:%M:%S+02:00') WHEN 6 THEN strftime(t, '%Y-%m-%dT%H:%M:%S.%gZ')
         WHEN 7 THEN strftime(t, '%Y-%m-%dT%H:%M:%S-0530') ELSE strftime(t, '%d/%m/%Y %H:%M') END AS text,
       CASE k WHEN 0 THEN s WHEN 1 THEN t WHEN 2 THEN s WHEN 3 THEN date_trunc('minute', t) WHEN 4 THEN CAST(date_trunc('day', t) AS TIMESTAMP)
         WHEN 5 THEN s - INTERVAL 2 HOUR WHEN 6 THEN date_trunc('millisecond', t) WHEN 7 THEN s + INTERVAL 330 MINUTE END AS time_stamp
FROM S""",
        "interval_null_items": f"""WITH {_LOST}, {_history('day')}, {_HOURS}, {_SPANS},
S AS ({_COMBINED.format(readings='hours').replace('r.item = spans.item', 'r.item IS NOT DISTINCT FROM spans.item')})
SELECT f.form AS form, S.* FROM S, (VALUES ('scan'), ('bins')) AS f(form)""",
        "reader_agreement": """
SELECT r.reader AS reader, event_type AS item, count(*) AS count
FROM events, (VALUES ('archive'), ('decoded'), ('live')) AS r(reader)
WHERE event_type NOT IN ('error', 'signup') GROUP BY 1, 2""",
        "restart_on_message": f"""WITH {_P}, {served}
SELECT n.named AS named, e.epoch AS epoch, item, batch, real, batch + real AS total
FROM served, (VALUES (true), (false)) AS n(named), (VALUES ('waiting'), ('active')) AS e(epoch)""",
        "serving_null_units": "SELECT event_type AS item, count(*) AS batch, CAST(0 AS BIGINT) AS real, count(*) AS total FROM events GROUP BY 1",
        "batch_sizes": f"WITH {_P} SELECT count(*) AS rows FROM P GROUP BY unit",
        "count_per_item_update": _COUNT,
        "tie_spread": f"""WITH {_P}, H AS (SELECT item, date_trunc('hour', time_stamp) AS t, id FROM P)
SELECT item, CAST(t AS TIMESTAMP)
         + to_milliseconds(row_number() OVER (PARTITION BY item, t ORDER BY id) - 1) AS time_stamp, id
FROM H""",
        "tie_mask": f"""WITH {_P}
SELECT id, item, count(*) OVER (PARTITION BY item, date_trunc('hour', time_stamp)) > 1 AS in_tie FROM P""",
        "event_gap": f"""WITH {_P}
SELECT id, item, date_diff('microsecond',
       lag(time_stamp) OVER (PARTITION BY item ORDER BY time_stamp, id), time_stamp) AS gap_us
FROM P""",
        "snapshot_gap": f"""WITH {_P}, {_history('hour')}
SELECT item, time_stamp, count, date_diff('microsecond',
       lag(time_stamp) OVER (PARTITION BY item ORDER BY time_stamp), time_stamp) AS gap_us
FROM hour_history""",
        "positional_slice": f"""WITH {_P}
SELECT item, time_stamp, id FROM P
QUALIFY row_number() OVER (PARTITION BY item ORDER BY time_stamp, id) BETWEEN 3 AND 66""",
        "row_position": f"""WITH {_P}
SELECT id, row_number() OVER (ORDER BY time_stamp, id) - 1 AS position FROM P""",
        "running_total_periods": f"""WITH {_P}
SELECT item, time_stamp, id, CAST(sum(price) OVER (PARTITION BY item ORDER BY time_stamp, id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulated
FROM P""",
        "row_position_ranges": f"""WITH {_P}
SELECT id, row_number() OVER (PARTITION BY item ORDER BY date_trunc('day', time_stamp), id) - 1 AS position FROM P""",
        "interval_combined": f"""WITH {_P}, {_history('day')}, {_HOURS}, {_SPANS}
{_COMBINED.format(readings='hours')}""",
        "interval_events": f"""WITH {_P}, {_history('day')}, {_SPANS}
{_COMBINED.format(readings='(SELECT item, time_stamp, 1 AS count FROM P)')}""",
        "delay_series": f"""WITH {_P}, {_history('hour')},
H AS (SELECT item, CAST(date_trunc('hour', time_stamp) AS TIMESTAMP) AS t, id FROM P),
N AS (SELECT item, t, row_number() OVER (PARTITION BY item ORDER BY t, id) AS cumulated FROM H),
X AS (SELECT item, cumulated,
             t + to_milliseconds(cumulated - min(cumulated) OVER (PARTITION BY item, t)) AS time_x
      FROM N)
SELECT coalesce(X.item, y.item) AS item, coalesce(X.cumulated, y.count) AS cumulated, time_x,
       y.time_stamp AS time_y, date_diff('microsecond', time_x, y.time_stamp) AS delay_us
FROM X FULL JOIN hour_history y ON y.item = X.item AND y.count = X.cumulated""",
        "delay_null_items": f"""WITH {_LOST}, {_history('hour')},
H AS (SELECT item, CAST(date_trunc('hour', time_stamp) AS TIMESTAMP) AS t, id FROM P),
N AS (SELECT item, t, row_number() OVER (PARTITION BY item ORDER BY t, id) AS cumulated FROM H),
X AS (SELECT item, cumulated,
             t + to_milliseconds(cumulated - min(cumulated) OVER (PARTITION BY item, t)) AS time_x
      FROM N)
SELECT coalesce(X.item, y.item) AS item, coalesce(X.cumulated, y.count) AS cumulated, time_x,
       y.time_stamp AS time_y, date_diff('microsecond', time_x, y.time_stamp) AS delay_us
FROM X FULL JOIN hour_history y ON y.item IS NOT DISTINCT FROM X.item AND y.count = X.cumulated""",
        "timeline_union": f"""WITH {_P}, {_history('day')}, {_HOURS}, {_SPANS}
SELECT item, time_stamp, row_number() OVER (PARTITION BY item ORDER BY time_stamp, id) AS cumulated,
       'all_data' AS category FROM P
UNION ALL SELECT item, time_stamp, count, 'HadoopResults' FROM day_history
UNION ALL SELECT item, time_stamp, count, 'SparkResults' FROM hours
UNION ALL SELECT item, time_stamp, cumulated, 'SparkResults+HadoopResults'
          FROM ({_COMBINED.format(readings='hours')})""",
        "enrich_catalogue": f"""WITH slots AS (SELECT CAST(event_id AS VARCHAR) AS id, {_SLOT} AS item FROM events),
catalogue(item, snack, price) AS (VALUES
  ('position_1', 'apple', 1.0), ('position_2', 'banana', 1.0), ('position_3', 'orange', 1.0),
  ('position_4', 'blueberries', 2.0), ('position_5', 'snickers', 3.0), ('position_6', 'mars', 3.0),
  ('position_7', 'twix', 3.0), ('position_8', 'milkyway', 3.0))
SELECT id, slots.item AS item, snack, CAST(price AS DOUBLE) AS price, CAST(price AS DOUBLE) AS price_by_name,
       CASE WHEN slots.item IN ('position_1', 'position_2', 'position_3', 'position_4')
            THEN 'healthy' ELSE 'not_healthy' END AS healthy_food
FROM slots LEFT JOIN catalogue ON catalogue.item = slots.item""",
        "healthy_label": f"""
SELECT CASE WHEN {_SLOT} IN ('position_1', 'position_2', 'position_3', 'position_4')
       THEN 'healthy' ELSE 'not_healthy' END AS healthy_food, count(*) AS count
FROM events GROUP BY 1""",
        "unprofitable_machines": f"""WITH {_P}
SELECT snack_automat_id, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS sold
FROM P GROUP BY 1 HAVING sum(price) < {REVENUE_FLOOR}""",
        "top_machines": f"""WITH {_P}
SELECT snack_automat_id, count(*) AS sold, count(DISTINCT customer_id) AS customers,
       CAST(sum(price) AS DOUBLE) AS revenue
FROM P GROUP BY 1 ORDER BY sold DESC, snack_automat_id LIMIT 10""",
        "healthy_share": f"""WITH {_P}
SELECT healthy_food, count(*) AS sold, CAST(sum(price) AS DOUBLE) AS revenue,
       count(*) / (SELECT count(*) FROM P) AS share
FROM P GROUP BY 1""",
        "stockout_risk": f"""WITH {_P}, G AS (
  SELECT snack_automat_id, item, count(*) AS sold,
         count(*) FILTER (time_stamp > (SELECT max(time_stamp) FROM P) - INTERVAL 72 HOUR) AS recent
  FROM P GROUP BY 1, 2)
SELECT *, greatest({CAPACITY} - sold, 0) AS stock_left,
       CASE WHEN recent > 0 THEN greatest({CAPACITY} - sold, 0) * CAST(72 AS DOUBLE) / recent END AS hours_left
FROM G""",
        "silent_machines": f"""WITH {_P}, G AS (
  SELECT snack_automat_id, count(*) AS sold, min(time_stamp) AS first_seen, max(time_stamp) AS last_seen
  FROM P GROUP BY 1 HAVING count(*) > 1),
M AS (SELECT snack_automat_id, sold, last_seen,
             date_diff('microsecond', first_seen, last_seen) / (sold - 1) AS mean_gap_us,
             date_diff('microsecond', last_seen, (SELECT max(time_stamp) FROM P)) AS silence_us
      FROM G)
SELECT * FROM M WHERE silence_us > 3 * mean_gap_us""",
        "silent_machines_live": f"""WITH {_P}, G AS (
  SELECT snack_automat_id, count(*) AS sold, min(time_stamp) AS first_seen, max(time_stamp) AS last_seen
  FROM P GROUP BY 1 HAVING count(*) > 1),
M AS (SELECT snack_automat_id, sold, last_seen,
             date_diff('microsecond', first_seen, last_seen) / (sold - 1) AS mean_gap_us,
             date_diff('microsecond', last_seen, (SELECT max(time_stamp) FROM P)) AS silence_us
      FROM G)
SELECT * FROM M WHERE silence_us > 3 * mean_gap_us""",
        "paced_totals": _COUNT,
    }
