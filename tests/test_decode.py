import pytest
from pyspark.sql import functions as F

from tallyline.functions import decode, decode_rows, encode, enrich, health_label, parse_any_time, parse_time, price_of
from tallyline.operators import count_by, count_items
from tallyline.sources import read_archive_json
from tests.helpers import rows

FULL = (
    '{"item":"position_1","customer_id":146,"healthy_food":"healthy","price":1,'
    '"snack_automat_id":"SNACK--36","timestamp":"2024-08-01 13:31:21","ones":1}'
)
# Line, reason it is refused (None: accepted).
LINES = [
    (FULL, None),
    ('{"item":"","customer_id":"x"}', "empty item"),
    ('{"customer_id":3}', "missing item"),
    ('{"item":null}', "missing item"),
    ("{}", "missing item"),
    ("not json", "malformed"),
    ('{"item":"position_1","price":3.5', "malformed"),
    ("[1]", "malformed"),
    ("", "malformed"),
    ('{"item":5,"price":"abc"}', None),
    ('{"item":"position_2","timestamp":"2024-08-01 25:31:21"}', None),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(text,) for text, _ in LINES], "value STRING")


def test_events_and_rejects_share_the_lines(lines):
    good, rejects = decode(lines)
    assert rows(good, "item") == [("5",), ("position_1",), ("position_2",)]
    expected = sorted((text, reason) for text, reason in LINES if reason)
    assert sorted(tuple(r) for r in rejects.select("value", "reason").collect()) == expected


def test_fields_are_typed_and_bad_ones_null(lines):
    row = decode_rows(lines).filter("item = 'position_1'").select(
        "customer_id", F.col("price").cast("string").alias("price"), "snack_automat_id",
        F.date_format("time_stamp", "yyyy-MM-dd HH:mm:ss").alias("t"),
    ).first()
    assert tuple(row) == (146, "1.00", "SNACK--36", "2024-08-01 13:31:21")
    assert decode_rows(lines).filter("item = '5'").first()["price"] is None
    assert decode_rows(lines).filter("item = 'position_2'").first()["time_stamp"] is None


def test_bytes_are_read_as_utf8(spark):
    frame = spark.createDataFrame([(bytearray('{"item":"plátano"}', "utf-8"),)], "value BINARY")
    assert rows(decode_rows(frame), "item") == [("plátano",)]


def test_every_way_of_counting_uses_the_same_rule(spark, lines, folder):
    expected = [("5", 1), ("position_1", 1), ("position_2", 1)]
    assert rows(count_by(decode_rows(lines))) == expected
    parsed = lines.select(F.from_json("value", "item STRING").getField("item").alias("item"))
    assert rows(count_items(parsed)) == expected
    lines.withColumn("unit", F.lit("u")).write.partitionBy("unit").text(f"{folder}/log")
    scanned = read_archive_json(spark, f"{folder}/log")
    assert rows(count_by(scanned)) == expected


def test_archive_scan_and_decoder_agree_on_odd_lines(spark, folder):
    lines = ['[{"item":"a"}]', '[{"item":"a"},{"item":"a"}]', '{"item":"","item":"a"}', '{"item":"b"}']
    frame = spark.createDataFrame([(x, "u") for x in lines], "value STRING, unit STRING")
    frame.write.partitionBy("unit").text(f"{folder}/log")
    assert rows(count_by(read_archive_json(spark, f"{folder}/log"))) == rows(count_by(decode_rows(frame)))


def test_payload_is_parsed_once(lines):
    plan = decode_rows(lines, fields=["item"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "price" not in plan


def test_encode_and_decode_keep_microseconds(spark):
    events = spark.sql(
        "SELECT '7' AS id, 'position_3' AS item, 9L AS customer_id, 'healthy' AS healthy_food, "
        "CAST(2.5 AS DECIMAL(18,2)) AS price, 'SNACK--1' AS snack_automat_id, "
        "TIMESTAMP'2024-01-02 03:04:05.678901' AS time_stamp"
    )
    back = decode_rows(encode(events)).select(*events.columns)
    assert back.collect() == events.collect()


def test_time_text(spark):
    texts = ["2024-08-01 13:31:21", "2024-08-01 13:31:21.5", "2024-08-01", "x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t STRING").select(parse_time("t").cast("string")).collect()
    assert [r[0] for r in got] == ["2024-08-01 13:31:21", "2024-08-01 13:31:21.5", None, None, None]


def test_enrichment(spark):
    slots = spark.createDataFrame([("position_4",), ("position_5",), ("position_9",)], "item STRING")
    got = rows(enrich(slots).select("item", "snack", F.col("price").cast("int"), "healthy_food"))
    assert got == [
        ("position_4", "blueberries", 2, "healthy"),
        ("position_5", "snickers", 3, "not_healthy"),
        ("position_9", None, None, "not_healthy"),
    ]
    priced = slots.select(price_of(F.lit("twix")).cast("int"), price_of(F.lit("tea")), health_label(F.col("item")))
    assert tuple(priced.first()) == (3, None, "healthy")


def test_enrichment_takes_another_catalogue(spark):
    slots = spark.createDataFrame([("position_1",)], "item STRING")
    other = spark.sql("SELECT 'position_1' AS item, 'tea' AS snack, CAST(4 AS DECIMAL(18,2)) AS price")
    assert enrich(slots, other).first()["snack"] == "tea"


def test_times_as_people_write_them(spark):
    # Texts that an earlier reader took for no time, and recorded ones.
    texts = {
        "2024-08-01T13:22:20": "2024-08-01 13:22:20", "2024-08-01 13:22": "2024-08-01 13:22:00", "2024-08-01": "2024-08-01 00:00:00",
        "2024-08-01 13:22:20+02:00": "2024-08-01 11:22:20", "2024-08-01 13:22:20Z": "2024-08-01 13:22:20",
        "2024-08-02 09:47:40.161": "2024-08-02 09:47:40.161", "2024-08-02 09:47:40.161000+0000": "2024-08-02 09:47:40.161",
        " 2024-08-01 13:22:20 ": "2024-08-01 13:22:20", "2024-08-01T13:22:20.123456789Z": "2024-08-01 13:22:20.123456",
        "2024-08-01 13:22:20 +01:00": "2024-08-01 12:22:20", "01/08/2024": None, "13:22": None, "2024-13-01": None, "": None, "later": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t STRING")
    got = {r[0]: r[1] for r in frame.select("t", parse_any_time("t").cast("string")).collect()}
    assert got == {**texts, None: None}
