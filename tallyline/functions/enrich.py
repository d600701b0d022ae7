"""Catalogue lookups: slot to article, price and health class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Slot, article, price.
CATALOGUE = (
    ("position_1", "apple", 1),
    ("position_2", "banana", 1),
    ("position_3", "orange", 1),
    ("position_4", "blueberries", 2),
    ("position_5", "snickers", 3),
    ("position_6", "mars", 3),
    ("position_7", "twix", 3),
    ("position_8", "milkyway", 3),
)
# Slots with healthy articles.
HEALTHY_SLOTS = ("position_1", "position_2", "position_3", "position_4")


def catalogue(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{slot}', '{snack}', {price})" for slot, snack, price in CATALOGUE)
    return spark.sql(
        "SELECT item, snack, CAST(price AS DECIMAL(18,2)) AS price "
        f"FROM VALUES {rows} AS t(item, snack, price)"
    )


def health_label(item: Column) -> Column:
    return F.when(item.isin(*HEALTHY_SLOTS), F.lit("healthy")).otherwise(F.lit("not_healthy"))


def price_of(snack: Column) -> Column:
    """Price by article name; null for an unknown one."""
    pairs = [F.lit(x) for _, snack_name, price in CATALOGUE for x in (snack_name, price)]
    return F.try_element_at(F.create_map(*pairs), snack).cast("decimal(18,2)")


def enrich(df: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Add ``snack``, ``price`` and ``healthy_food`` to rows with a slot in ``item``.

    The built-in catalogue has eight rows and is broadcast. A dimension handed in is joined
    without a hint, as its size is not known here.
    """
    base = df.drop("snack", "price", "healthy_food")
    if dimension is None:
        dimension = F.broadcast(catalogue(df.sparkSession))
    return base.join(dimension, "item", "left").withColumn("healthy_food", health_label(F.col("item")))
