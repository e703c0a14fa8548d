"""How the stream queries lay out their messages."""

import glob

from pyspark.sql import functions as F

from conftest import rows
from statforge.functions import messages as M
from statforge.operators import upsert as U
from statforge.plans import queries, views
from statforge.plans.bindings import Tables
from statforge.session import shared_dir


def test_more_rows_make_more_files_but_not_fewer_batches(spark, folder):
    """A fixed number of files made one task read a fixed share of all messages."""
    spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"),
        F.when(F.col("id") % 50 != 0, F.col("id") % 40).alias("user_id"),
        F.lit("view").alias("event_type"),
        (F.col("id") % 7).cast("double").alias("value"),
    ).write.parquet(f"{folder}/events.parquet")
    tables = Tables(spark, folder)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for partitions in (2, 6):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            at, lots = f"{folder}/in{partitions}", 3
            source = queries._event_stream(tables, tables.events, lots, at)
            batches = []
            writer = source.writeStream.foreachBatch(lambda batch, _: batches.append((batch.count(), batch.select(F.input_file_name()).distinct().count())))
            writer.option("checkpointLocation", f"{at}-cp").trigger(availableNow=True).start().awaitTermination()
            assert len(spark.read.parquet(at).inputFiles()) == lots * partitions
            assert sum(n for n, _ in batches) == 3000 and lots <= len(batches) and max(files for _, files in batches) == partitions
            expected = queries.B.event_messages(tables)
            assert spark.read.parquet(at).exceptAll(expected).count() == 0 and expected.exceptAll(spark.read.parquet(at)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_files_of_standings_messages_stay_small(spark, folder, monkeypatch):
    """Files grew with the table, and with them the rows that one task sorted and spilled."""
    number = F.col("id")
    spark.range(700).select(
        F.when(number % 50 != 0, number / 7).cast("bigint").alias("l_orderkey"),
        (number % 7).cast("int").alias("l_linenumber"),
        (number % 20).alias("l_suppkey"),
        (number % 30).alias("l_partkey"),
        (number % 50).cast("double").alias("l_quantity"),
        F.when(number % 3 == 0, "R").when(number % 3 == 1, "").alias("l_returnflag"),
        F.when(number % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(20).select(
        number.alias("c_custkey"), F.concat(F.lit("C"), number.cast("string")).alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit("M").alias("c_mktsegment")
    ).write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(queries, "TOPIC_FILE_MESSAGES", 40)
    seen = set(glob.glob(f"{shared_dir(spark)}/topics-*"))
    got = queries.QUERIES["stream_standings"](spark, folder)
    (root,) = set(glob.glob(f"{shared_dir(spark)}/topics-*")) - seen
    sent = spark.read.parquet(f"{root}/standings-in")
    messages = queries.B.standings_messages(Tables(spark, folder))
    assert sent.exceptAll(messages).count() == 0 and messages.exceptAll(sent).count() == 0 and sent.count() == 700
    assert max(n for n, in rows(sent.groupBy(F.input_file_name()).count().select("count"))) <= 40
    flat = M.flatten_standings(M.parse(messages, M.STANDINGS), audit=False)
    want = queries.comparable(U.newest_in_batch(flat, views.STANDING_KEY, None, ["group_name"]))
    assert 0 < want.count() < flat.count() and sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
