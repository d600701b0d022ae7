"""Counts per key, for batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str] = ("item",)) -> DataFrame:
    """Rows per key as BIGINT. Spark combines on the map side, so a hot key costs no more."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_items(df: DataFrame, keys: Sequence[str] = ("item",)) -> DataFrame:
    """Count rows with a usable ``item``, for frames that still hold rejects.

    The rule is applied inside the count. A filter before it would be pushed into whatever
    computes ``item``, which for JSON text means parsing every line again.
    """
    usable = F.when(F.col("item") != F.lit(""), F.lit(1))
    return df.groupBy(*keys).agg(F.count(usable).alias("count")).filter(F.col("count") > 0)
