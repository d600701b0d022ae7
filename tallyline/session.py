"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Tasks that list the folders of a file topic or view; Spark's own setting gives each of up to 10,000 folders a task.
LISTING_TASKS = 64
_made: list[str] = []


def build_session(app: str = "tallyline", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution and RocksDB streaming state."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def few_listing_tasks(spark: SparkSession, tasks: int = LISTING_TASKS) -> None:
    """Let this session, and streams that it starts, list many folders in at most ``tasks`` tasks.

    A task of its own for each folder costs the driver far more than the names that it sends.
    """
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, below the folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster the
    setting is required, as executors on other machines must see the files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # ``local-cluster`` has executors of their own, like any cluster.
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tallyline-")
    path = f"{root.rstrip('/')}/tallyline/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Remove the work folders that this process has made and return their number.

    For when the results of its queries have been read or written: they may rest on these folders.
    Folders of other processes are not touched.
    """
    return remove_work(spark, work_folders())


def work_folders() -> list[str]:
    """The work folders that this process has made and not removed."""
    return list(_made)


def remove_work(spark: SparkSession, folders: list[str]) -> int:
    """Remove some of these folders and return how many there were."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for folder in folders:
        if folder in _made:
            _made.remove(folder)
            path = jvm.org.apache.hadoop.fs.Path(folder)
            removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def rests_on(df: DataFrame, folders: list[str]) -> list[str]:
    """Those of the work folders that ``df`` reads files of."""
    read = {part for f in df.inputFiles() for part in f.split("/")}
    return [folder for folder in folders if folder.rstrip("/").rsplit("/", 1)[1] in read]


def release(df: DataFrame) -> None:
    """Remove the work folders that ``df``, a ``stored`` table, is read from: for tables that nothing rests on any more."""
    remove_work(df.sparkSession, rests_on(df, work_folders()))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    For results that are read several times, and for rows that must be the same in each reading.
    The files outlive a lost executor.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
