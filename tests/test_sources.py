import pytest
from pyspark.errors import AnalysisException

from tallyline.schema import BATCH_VIEW, CSV_REALTIME_VIEW
from tallyline.session import clear_work, stored, work_dir
from tallyline.sources import (
    ensure_table, ensure_view, purchases, read_csv_view, read_events, read_view, stream_purchases,
)
from tests.helpers import rows


def test_csv_columns_are_named_by_position(spark, tmp_path):
    # Fixed value: one line in the layout of the recorded views.
    (tmp_path / "view.csv").write_text("x1,44,banana,2024-08-02 09:48:24.090\n")
    row = read_csv_view(spark, str(tmp_path), CSV_REALTIME_VIEW).first()
    assert (row["id"], row["count"], row["item"], row["time_stamp"].microsecond) == ("x1", 44, "banana", 90_000)


def test_view_is_created_once(spark, folder):
    assert ensure_view(spark, f"{folder}/v", BATCH_VIEW, ("run_id",)).count() == 0
    row = spark.sql("SELECT 'a' AS item, 1L AS count, current_timestamp() AS time_stamp, 'i' AS id, 1L AS run_id")
    row.write.mode("append").partitionBy("run_id").parquet(f"{folder}/v")
    assert ensure_view(spark, f"{folder}/v", BATCH_VIEW, ("run_id",)).count() == 1
    assert read_view(spark, f"{folder}/v", BATCH_VIEW).schema["run_id"].dataType.simpleString() == "bigint"


def test_table_is_created_once(spark, folder):
    for _ in range(2):
        table = ensure_table(spark, "batch_view_test", BATCH_VIEW, ("run_id",), f"{folder}/t")
    assert table.columns == BATCH_VIEW.fieldNames()
    spark.sql("DROP TABLE batch_view_test")


def test_broker_format_is_passed_on(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_events(spark, "kafka", streaming=True, options={"subscribe": "t"})


def test_work_folder_follows_the_setting(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "x") != work_dir(spark, "x")
    assert rows(stored(spark.range(3), "x")) == [(0,), (1,), (2,)]


def test_table_reads_as_batch_and_stream_alike(spark):
    folder = "/root/testdata/sf0.001"
    batch, live = purchases(spark, folder), stream_purchases(spark, folder)
    assert live.isStreaming and live.schema == batch.schema


def test_own_work_folders_can_be_removed(spark):
    clear_work(spark)
    kept = stored(spark.range(3), "kept")
    assert kept.count() == 3
    path = kept.inputFiles()[0]
    assert clear_work(spark) == 1 and clear_work(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
