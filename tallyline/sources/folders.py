"""Folders and small text files of any store that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

GLOB = "*?[{"


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on a disk, as this machine sees it, and in no store of its own."""
    return _at(spark, path)[0].getUri().getScheme() == "file"


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make an empty folder if there is nothing at ``path``; patterns are left alone."""
    if not any(c in path for c in GLOB):
        fs, place = _at(spark, path)
        fs.mkdirs(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    jvm = spark._jvm
    fs, place = _at(spark, path)
    try:
        stream = fs.open(place)
    except Exception as error:  # a Java exception: only a file that is not there is no error
        if "FileNotFound" in str(error):
            return None
        raise
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: readers see the old text or the new one.

    The text goes to a file of its own, which then takes the place of the old one.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, place = _at(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
    context.rename(context.makeQualified(fresh), context.makeQualified(place), how)
