"""Typed columns to payload text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schema import TIME_FORMAT_MICROS

PAYLOAD_FIELDS = (
    "id", "item", "customer_id", "healthy_food", "price", "snack_automat_id", "timestamp",
)


def machine_name(number: Column) -> Column:
    """Machine id text; the prefix is a fixed value of the payload format."""
    return F.concat(F.lit("SNACK--"), number.cast("string"))


def encode(df: DataFrame, keep: tuple[str, ...] = (), time_format: str = TIME_FORMAT_MICROS) -> DataFrame:
    """One JSON line per event in ``value``; the columns in ``keep`` stay beside it."""
    fields = []
    for name in PAYLOAD_FIELDS:
        if name == "timestamp":
            fields.append(F.date_format("time_stamp", time_format).alias("timestamp"))
        elif name in df.columns:
            fields.append(F.col(name))
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))
