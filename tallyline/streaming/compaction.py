"""Compaction of an archive: few files for each closed unit, beside the files that the stream wrote.

The stream goes on writing below the archive's own path. A compaction writes the lines of closed units
once more, dealt by unit and, where a unit is large, by a salt that follows its bytes. A manifest of
one small file, replaced in one step, says which units are compacted and which files they had. Readers
take the compacted lines and all files the manifest does not cover, so each line is seen once, before,
during and after a compaction, also a line that came late to a compacted unit.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import stored
from tallyline.sources.folders import ensure_folder, read_text, replace_text
from tallyline.sources.topics import FEW_NAMES, SETTLE_S, topic_files, without_files

TARGET_BYTES = 128 << 20
LINES = "value STRING, unit STRING"
FILES = "file STRING, time TIMESTAMP, unit STRING"


def _place(path: str) -> str:
    return f"{path.rstrip('/')}_compacted"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, f"{_place(path)}/manifest")
    return json.loads(text) if text else None


def _files(spark: SparkSession, path: str, done: dict) -> DataFrame:
    """The files whose lines are compacted."""
    return spark.read.schema(FILES).parquet(*[f"{_place(path)}/{name}" for name in done["files"]])


def read_archive_lines(spark: SparkSession, path: str, few_names: int = FEW_NAMES) -> DataFrame:
    """All ``(value, unit)`` lines of an archive, each once, from compacted files where there are some.

    Of the archive's own folders only those of units behind the compacted ones are read, and in the
    others files that came late.
    """
    raw, done = spark.read.schema(LINES).text(path), _manifest(spark, path)
    if done is None:
        return raw.select("value", "unit")
    compacted = spark.read.schema(LINES).option("basePath", _place(path)).text([f"{_place(path)}/{run}" for run in done["runs"]])
    behind = raw.filter((F.col("unit") > done["upto"]) | F.col("unit").isNull())
    recent = _files(spark, path, done).filter(F.unix_micros("time") >= done["since"])
    late = without_files(raw.filter(F.col("unit") <= done["upto"]), done["since"], recent, few_names)
    return compacted.select("value", "unit").unionByName(behind.select("value", "unit")).unionByName(late.select("value", "unit"))


def dealt_by_size(lines: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Lines dealt by unit, and over as many tasks for a unit as its bytes fill files of ``target_bytes``."""
    sizes = lines.groupBy(F.col("unit").alias("_unit")).agg(F.sum(F.octet_length("value") + 1).alias("_bytes"))
    sized = lines.join(stored(sizes, "sizes"), F.col("unit").eqNullSafe(F.col("_unit")))
    files = F.ceil(F.col("_bytes") / F.lit(target_bytes))
    # Numbers of rows, as copies of a line may be many.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), files)
    return sized.withColumn("_salt", salt).repartition("unit", "_salt").select("value", "unit")


def compact_archive(
    spark: SparkSession, path: str, before: str, target_bytes: int = TARGET_BYTES, settle_s: int = SETTLE_S
) -> int:
    """Compact the units that sort below ``before`` and return the number of compactions so far.

    These units are closed. A file that comes to one of them all the same is read beside the compacted
    lines, if its commit follows within ``settle_s`` seconds of its time, and goes into the next
    compaction in any case. Lines without a unit are left as they are. A compaction that broke off
    is done again from the start; one runs at a time. Files of an earlier compaction are not read again.
    """
    done = _manifest(spark, path) or {"upto": "", "since": None, "runs": [], "files": []}
    place, number = _place(path), len(done["runs"]) + 1
    ensure_folder(spark, place)
    run, record = f"run={number:06d}", f"files={number:06d}"
    there = topic_files(spark, path).filter(F.col("unit") < before)
    if done["files"]:
        there = there.join(_files(spark, path, done).select("file"), "file", "left_anti")
    there.write.mode("overwrite").parquet(f"{place}/{record}")
    fresh = spark.read.schema(FILES).parquet(f"{place}/{record}")
    row = fresh.agg(
        F.max("unit").alias("upto"), F.min(F.unix_micros("time")).alias("first"), F.max(F.unix_micros("time")).alias("last")
    ).first()
    if row["upto"] is None:
        return number - 1
    lines = spark.read.schema(LINES).text(path).filter(F.col("unit") < before)
    lines = lines.filter(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(row["first"]).cast("bigint")))
    lines = lines.withColumn("file", F.col("_metadata.file_path")).join(fresh.select("file"), "file", "left_semi")
    dealt_by_size(lines.select("value", "unit"), target_bytes).write.mode("overwrite").partitionBy("unit").text(f"{place}/{run}")
    since = max(row["last"] - settle_s * 1_000_000, done["since"] or 0)
    manifest = {
        "upto": max(row["upto"], done["upto"]), "since": since, "runs": [*done["runs"], run], "files": [*done["files"], record],
    }
    replace_text(spark, f"{place}/manifest", json.dumps(manifest))
    return number
