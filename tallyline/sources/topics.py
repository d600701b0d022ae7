"""Event topics: payload text with the ingestion unit each payload came in.

A unit is a slice of the log that never changes once closed: a ``unit=`` folder of a file topic,
one file of a flat folder, or a run of offsets of one Kafka partition. Batch and stream readers
that agree on units can split the log between them without gap or overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.decode import decode_rows
from tallyline.session import few_listing_tasks
from tallyline.sources.folders import ensure_folder, exists

OFFSETS_PER_UNIT = 1_000_000
# From a file's time to its commit at most; files older than this at a start are known by time alone.
SETTLE_S = 3_600
# Names of recent files that go into a filter; more are joined.
FEW_NAMES = 1_000


def offset_unit(partition: str, offset: str, per_unit: int = OFFSETS_PER_UNIT, topic: str = "topic") -> Column:
    """Unit of a log record: its topic, its partition and its run of offsets, in sortable text."""
    return F.format_string("%s:%05d:%012d", F.col(topic), F.col(partition), F.floor(F.col(offset) / F.lit(per_unit)))


def source_of(unit: str) -> Column:
    """What a unit's order holds within: a log partition, or all of a file topic."""
    return F.regexp_extract(unit, "^(.*):", 1)


def topic_files(spark: SparkSession, location: str) -> DataFrame:
    """``(file, time, unit)`` of all files of a file topic, from names and times alone; no file is opened."""
    few_listing_tasks(spark)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    # Folder names escape some characters, and paths escape them once more.
    folder = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), "/unit=([^/]*)/", 1), F.lit(""))
    plain = folder
    for _ in range(2):
        # A name that is not escaped text stands for itself.
        plain = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    unit = F.nullif(plain, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return there.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("time"), unit.alias("unit")
    )


def file_record(
    spark: SparkSession, location: str, record: str, settle_s: int = SETTLE_S, files: DataFrame | None = None
) -> DataFrame:
    """What a topic held when it was first asked for: ``(since, file)``, out of ``record``.

    ``since`` lies ``settle_s`` before the newest file (null for an empty topic, no row for a file).
    Files below it are past; the files from it on are named one by one. Written once, from names and
    times alone, and read back at each later start; a try that did not come to its end is done again.
    ``files`` are the topic's files where the caller has listed them.
    """
    if not exists(spark, f"{record}/_SUCCESS"):
        there = topic_files(spark, location) if files is None else files
        newest = there.agg((F.max("time") - F.make_dt_interval(secs=F.lit(settle_s))).alias("since"))
        since = F.timestamp_micros(F.lit(newest.select(F.unix_micros("since").alias("s")).first()["s"]).cast("bigint"))
        named = there.filter(F.col("time") >= since).select(since.alias("since"), "file")
        start = spark.range(1).select(since.alias("since"), F.lit(None).cast("string").alias("file"))
        start.unionByName(named).write.mode("overwrite").parquet(record)
    return spark.read.schema("since TIMESTAMP, file STRING").parquet(record)


def without_files(rows: DataFrame, since: int | None, files: DataFrame, few_names: int = FEW_NAMES) -> DataFrame:
    """Rows of files that are not older than ``since`` (microseconds) and not among ``files`` (``file``).

    The time, and the names while they are few, are literals on the file's metadata, so files of the
    past are left out of the listing and never opened. Many names are joined instead.
    """
    if since is None:
        return rows
    name = F.col("_metadata.file_path")
    late = rows.filter(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(since).cast("bigint")))
    # At most ``few_names`` names and one more.
    names = [r["file"] for r in files.select("file").limit(few_names + 1).collect()]
    if len(names) <= few_names:
        return late.filter(~name.isin(names)) if names else late
    return late.withColumn("_file", name).join(files.select(F.col("file").alias("_file")), "_file", "left_anti").drop("_file")


def read_events(
    spark: SparkSession,
    fmt: str,
    location: str | None = None,
    streaming: bool = False,
    start: str = "earliest",
    unit: str = "folder",
    options: dict[str, str] | None = None,
    offsets_per_unit: int = OFFSETS_PER_UNIT,
    start_record: str | None = None,
    settle_s: int = SETTLE_S,
    few_names: int = FEW_NAMES,
) -> DataFrame:
    """Payloads as ``(value, unit)`` from a file topic (``fmt="text"``) or from ``fmt="kafka"``.

    ``start="latest"`` skips what is already there when a new stream begins. For file topics the
    newest time and the names of recent files at the first start are kept in ``start_record``, a
    folder that belongs to the checkpoint: a later start skips the same files and no others, so files
    that came in the meantime, also those of a unit that was open, are read. Files of the past are
    told by their time and are not opened. A writer may take up to ``settle_s`` seconds from a file's
    time to its commit; one that takes longer must be waited for before the first start. A file
    topic that a stream finds missing is made, and is empty.
    """
    options = options or {}
    few_listing_tasks(spark)
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if fmt == "kafka":
        if streaming:
            reader = reader.option("startingOffsets", start)
        log = reader.format("kafka").load()
        return log.select(
            F.col("value").cast("string").alias("value"),
            offset_unit("partition", "offset", offsets_per_unit).alias("unit"),
        )
    if streaming or start == "latest":
        ensure_folder(spark, location)
    if unit == "file":
        rows = reader.schema("value STRING").format(fmt).load(location)
        name = F.col("_metadata.file_name").alias("unit")
    else:
        rows = reader.schema("value STRING, unit STRING").format(fmt).load(location)
        name = F.col("unit")
    if start != "latest":
        return rows.select("value", name)
    if not start_record:
        raise ValueError("a start at the end of a file topic needs a start_record beside the checkpoint")
    known = file_record(spark, location, start_record, settle_s)
    since = known.agg(F.max(F.unix_micros("since")).alias("since")).first()["since"]
    return without_files(rows, since, known.filter("file IS NOT NULL"), few_names).select("value", name)


def read_archive_json(spark: SparkSession, location: str, fields: tuple[str, ...] = ("item",)) -> DataFrame:
    """Events of a JSON-lines archive with only ``fields`` parsed.

    Read as text and decoded like any other payload: Spark's JSON reader follows other rules for
    arrays and repeated fields, and two readers of one log must agree.
    """
    return decode_rows(read_events(spark, "text", location), fields=fields)
