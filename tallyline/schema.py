"""Canonical schemas of the event payload and of the stored views."""

from __future__ import annotations

from pyspark.sql import types as T

# Timestamp text in payloads; the fraction is optional when reading.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIME_FORMAT_READ = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Other ways people and programs write a time, tried in this order.
TIME_FORMATS_READ = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][ ]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][ ]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][ ]xx",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][ ]xx",
    "yyyy-MM-dd HH:mm[XXX]",
    "yyyy-MM-dd'T'HH:mm[XXX]",
    "yyyy-MM-dd",
)

MONEY = T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One article bought, as JSON text. ``ones`` is not read: a count needs no column of ones.
PAYLOAD = _struct(
    id=T.StringType(),
    item=T.StringType(),
    customer_id=T.LongType(),
    healthy_food=T.StringType(),
    price=MONEY,
    snack_automat_id=T.StringType(),
    timestamp=T.StringType(),
)

# The same event with its time parsed, as kept in the validation view.
RAW_VIEW = _struct(
    id=T.StringType(),
    item=T.StringType(),
    customer_id=T.LongType(),
    healthy_food=T.StringType(),
    price=MONEY,
    snack_automat_id=T.StringType(),
    time_stamp=T.TimestampType(),
    unit=T.StringType(),
)

BATCH_VIEW = _struct(
    item=T.StringType(),
    count=T.LongType(),
    time_stamp=T.TimestampType(),
    id=T.StringType(),
    run_id=T.LongType(),
)

REALTIME_VIEW = _struct(
    item=T.StringType(),
    unit=T.StringType(),
    count=T.LongType(),
    time_stamp=T.TimestampType(),
    id=T.StringType(),
    epoch=T.LongType(),
    batch_id=T.LongType(),
)

EPOCH_TABLE = _struct(unit=T.StringType(), published_at=T.TimestampType(), run_id=T.LongType())

ACTIVE_EPOCHS = _struct(activated_at=T.TimestampType(), epoch=T.LongType())

CONTROL = _struct(restart=T.StringType(), run_id=T.LongType())

# Headerless CSV exports of the views, columns in stored order.
CSV_BATCH_SPEED_EVENTS = (
    "id STRING, customer_id BIGINT, healthy_food STRING, item STRING, ones BIGINT, "
    "price DECIMAL(18,2), snack_automat_id STRING, time_stamp TIMESTAMP"
)
CSV_STREAM_ONLY_EVENTS = (
    "id STRING, customer_id BIGINT, healthy_food STRING, item STRING, "
    "price DECIMAL(18,2), snack_automat_id STRING, time_stamp TIMESTAMP"
)
CSV_BATCH_VIEW = "id STRING, count BIGINT, time_stamp TIMESTAMP, item STRING"
CSV_REALTIME_VIEW = "id STRING, count BIGINT, item STRING, time_stamp TIMESTAMP"
