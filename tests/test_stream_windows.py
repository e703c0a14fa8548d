"""Event-time windows, and one view over a batch layer and a stream's table."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statforge.operators import upsert as U
from statforge.streaming.jobs import run_until_done
from statforge.streaming.serving import merged_view
from statforge.streaming.store import UpsertTable
from statforge.streaming.windows import start_windows, windowed

SCHEMA = "t timestamp, k string"


def lot(spark, folder, data):
    df = spark.createDataFrame(data, "t string, k string").select(F.to_timestamp("t").alias("t"), "k")
    df.write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, out="out", checkpoint="checkpoint"):
    counted = windowed(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), "t", "5 minutes", "10 minutes", ["k"])
    run_until_done([start_windows(counted, f"{folder}/{out}", f"{folder}/{checkpoint}", available_now=True)])
    shown = F.date_format("window_start", "HH:mm").alias("w")
    return rows(spark.read.parquet(f"{folder}/{out}").select(shown, "k", "rows"), "w", "k")


def test_late_rows_are_left_out_and_a_restart_goes_on(spark, folder):
    lot(spark, folder, [("2024-01-01 10:01:00", "a"), ("2024-01-01 10:04:00", "a"), ("2024-01-01 10:06:00", "b"), (None, "a")])
    assert run(spark, folder) == []
    # Out of order but in time: the watermark is 09:56. Afterwards it is 10:20.
    lot(spark, folder, [("2024-01-01 10:02:00", "a"), ("2024-01-01 10:30:00", "a")])
    closed = [("10:00", "a", 3), ("10:05", "b", 1)]
    assert run(spark, folder) == closed
    # 10:03 and 10:18 are late; 10:21 is not, and 10:18's window has ended at 10:20.
    lot(spark, folder, [("2024-01-01 10:03:00", "a"), ("2024-01-01 10:18:00", "a"), ("2024-01-01 10:21:00", "a"), ("2024-01-01 11:00:00", "c")])
    assert run(spark, folder) == [*closed, ("10:20", "a", 1), ("10:30", "a", 1)]
    assert run(spark, folder) == [*closed, ("10:20", "a", 1), ("10:30", "a", 1)]


def test_a_table_gives_all_windows(spark):
    df = spark.createDataFrame([("2024-01-01 10:01:00", 2), ("2024-01-01 10:14:00", 3)], "t string, v int").withColumn("t", F.to_timestamp("t"))
    found = windowed(df, "t", "10 minutes", "1 minute", measures={"total": F.sum("v")}, slide="5 minutes")
    shown = found.select(F.date_format("window_start", "HH:mm").alias("w"), "total")
    assert rows(shown, "w") == [("09:55", 2), ("10:00", 2), ("10:05", 3), ("10:10", 3)]


def test_merged_view_takes_the_newest_of_both_layers(spark, folder):
    table = UpsertTable(spark, f"{folder}/table", ["k", "g"], "at", U.LATEST_EVENT, blank_null=["g"])
    changes = spark.createDataFrame([("a", None, 5, "stream"), ("b", "x", 1, "stream"), ("c", "x", 3, "stream")], "k string, g string, at int, v string")
    table.apply(changes, table.run_for("w"), 0)
    batch = spark.createDataFrame([("a", "", 4), ("b", "x", 2), ("c", "x", 3), ("d", None, None)], "k string, g string, at int")
    wanted = [("a", None, 5, "stream"), ("b", "x", 2, None), ("c", "x", 3, "stream"), ("d", None, None, None)]
    assert rows(merged_view(batch, table), "k") == wanted
    table.compact()
    assert rows(merged_view(batch, table), "k") == wanted
    later = spark.createDataFrame([("d", None, 9, "stream")], "k string, g string, at int, v string")
    table.apply(later, table.run_for("w"), 1)
    assert rows(merged_view(batch, table), "k")[3] == ("d", None, 9, "stream")
    with pytest.raises(ValueError, match="orders its changes"):
        merged_view(batch, UpsertTable(spark, f"{folder}/other", ["k"]))
