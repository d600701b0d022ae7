"""Payload text to typed columns, with one rule for what counts as an event.

A payload counts when it is a JSON object with a non-empty ``item``. Every consumer, batch or
stream, applies this same rule, so their totals can be compared row for row. Fields that cannot
be read become null and do not cost the event its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.time import parse_time
from tallyline.schema import PAYLOAD


def usable_item(item: Column | str = "item") -> Column:
    item = F.col(item) if isinstance(item, str) else item
    return item.isNotNull() & (item != F.lit(""))


def _narrow(schema: T.StructType, fields: Sequence[str] | None) -> T.StructType:
    if fields is None:
        return schema
    wanted = {"item", *fields}
    return T.StructType([f for f in schema.fields if f.name in wanted])


def _parsed(df: DataFrame, schema: T.StructType, keep_value: bool) -> DataFrame:
    # ``inline`` parses each payload once. With a plain ``data.*`` the filter on ``item`` is
    # pushed below the projection and the JSON text is parsed again for every use.
    rest = [F.col(c) for c in df.columns if c != "value"]
    text = F.col("value").cast("string")
    kept = [text.alias("value")] if keep_value else []
    return df.select(*rest, *kept, F.inline(F.array(F.from_json(text, schema))))


def decode_rows(
    df: DataFrame, schema: T.StructType = PAYLOAD, fields: Sequence[str] | None = None
) -> DataFrame:
    """Events of a frame with a ``value`` column (bytes or text); other columns pass through.

    ``fields`` limits parsing to the payload fields needed. Where ``timestamp`` is among them
    the parsed ``time_stamp`` takes its place.
    """
    rows = _parsed(df, _narrow(schema, fields), keep_value=False).filter(usable_item())
    if "timestamp" not in rows.columns:
        return rows
    return rows.withColumn("time_stamp", parse_time("timestamp")).drop("timestamp")


def reject_reason(value: Column, item: Column) -> Column:
    """Why a payload is not an event; null for one that is."""
    return (
        F.when(usable_item(item), F.lit(None).cast("string"))
        .when(F.json_object_keys(value).isNull(), F.lit("malformed"))
        .when(item.isNull(), F.lit("missing item"))
        .otherwise(F.lit("empty item"))
    )


def classify(
    df: DataFrame, schema: T.StructType = PAYLOAD, fields: Sequence[str] | None = None
) -> DataFrame:
    """Every payload with its fields, its text and the ``reason`` it is refused, in one pass."""
    rows = _parsed(df, _narrow(schema, fields), keep_value=True)
    return rows.withColumn("reason", reject_reason(F.col("value"), F.col("item")))


def decode(
    df: DataFrame, schema: T.StructType = PAYLOAD, fields: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split payloads into events and rejects; rejects keep their text and carry a reason.

    The two are read on their own, as two streams or two writes; ``classify`` gives both at once.
    """
    passed = [c for c in df.columns if c != "value"]
    refused = ~F.coalesce(usable_item(), F.lit(False))
    rejects = classify(df, schema, ["item"]).filter(refused).select(*passed, "value", "reason")
    return decode_rows(df, schema, fields), rejects
