"""Stored views: scans with fixed schemas and creation of empty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.session import few_listing_tasks


def read_csv_view(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A headerless export; columns are named by position through ``ddl``."""
    return spark.read.schema(ddl).option("header", "false").csv(path)


def read_view(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    few_listing_tasks(spark)
    return spark.read.schema(schema).format(fmt).load(path)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def ensure_view(
    spark: SparkSession, path: str, schema: T.StructType, partitions: tuple[str, ...] = (), fmt: str = "parquet"
) -> DataFrame:
    """Create an empty view at ``path`` if there is none, so readers need not wait for a first write."""
    no_rows(spark, schema).write.mode("ignore").partitionBy(*partitions).format(fmt).save(path)
    return read_view(spark, path, schema, fmt)


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, partitions: tuple[str, ...] = (),
    path: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """The same for a view that is a table of the catalogue."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{by}{where}")
    return spark.table(table)
