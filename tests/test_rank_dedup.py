import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import rows
from statforge.operators.dedup import drop_repeats, first_by_key, latest_by_key
from statforge.operators.ranking import global_rank, partition_rank
from statforge.operators.timeline import with_neighbours


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_keeps_one_defined_row(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "n"), (None, 1, "p"), (None, 2, "q")]
    expected = [(None, 2, "q"), (1, 5, "a"), (2, None, "n")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, v string").repartition(3)
        assert rows(latest_by_key(df, ["k"], "t"), "k") == expected


def test_dedup_is_idempotent_and_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    once = drop_repeats(df, ["k"], skip=["m"])
    assert rows(drop_repeats(once, ["k"]).select("k", "id"), "k") == rows(once.select("k", "id"), "k") == [(i, i) for i in range(7)]
    text = plan(once)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_keys_differ_by_blanks(spark):
    df = spark.createDataFrame([("1",), (" 1",)], "k string")
    assert first_by_key(df, ["k"]).count() == 2


@pytest.mark.parametrize("values", [[30.0] * 400, [float(i % 5) for i in range(300)], [7.0], [1.0, None, 2.0, None]])
def test_global_rank_equals_plain_windows(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s double").repartition(4)
    got = rows(global_rank(df, "s", "id", "r", "p", digits=None), "id")
    best = F.col("s").desc_nulls_last()
    order = [best, F.md5(F.col("id").cast("string"))]
    plain = df.select(
        "id",
        "s",
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("r"),
        F.percent_rank().over(Window.orderBy(best)).alias("p"),
    )
    assert got == rows(plain, "id")
    assert sorted(r[2] for r in got) == list(range(1, len(values) + 1))


def test_global_rank_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (3, 2.0)], "id int, s double")
    assert sorted(r[2] for r in rows(global_rank(df, "s", "id"))) == [1, 2, 3]


def test_global_rank_never_sorts_rows_in_one_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 100).cast("double").alias("s"))
    assert "SinglePartition" not in plan(global_rank(df, "s", "id"))
    money = spark.range(1000).select("id", (F.col("id") * 1e9).alias("s"))
    assert "SinglePartition" not in plan(global_rank(money, "s", "id"))


def test_a_hot_partition_is_not_windowed(spark):
    df = spark.range(1000).select(F.lit("all").alias("p"), (F.col("id") * 0.5).alias("x"), "id")
    ranked = partition_rank(df, ["p"], ["x"])
    assert "Window" not in plan(ranked)
    assert rows(ranked.select("id", "rank"), "id") == [(i, 1000 - i) for i in range(1000)]


def test_partition_rank_equals_rank(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.randrange(4), rng.choice([None, 1, 2]), rng.randrange(3), i) for i in range(500)]
    df = spark.createDataFrame(data, "p string, x int, y int, z int, i int")
    order = [F.col(c).desc_nulls_last() for c in "xyz"]
    plain = df.withColumn("rank", F.rank().over(Window.partitionBy("p").orderBy(*order)))
    assert rows(partition_rank(df, ["p"], ["x", "y", "z"]), "i") == rows(plain, "i")
    single = df.withColumn("rank", F.rank().over(Window.partitionBy("p").orderBy(order[0])))
    assert rows(partition_rank(df, ["p"], ["x"]), "i") == rows(single, "i")


@pytest.mark.parametrize("tie", [None, "t"])
def test_long_timelines_match_the_plain_window(spark, tie):
    rng = random.Random(2)
    days = rng.sample(range(10_000), 600) if tie is None else [rng.randrange(150) for _ in range(600)]
    data = [("hot", d, i, rng.choice([None, 1, 2, 3])) for i, d in enumerate(days)]
    data += [(f"k{i % 40}", i, i, i) for i in range(200)] + [("single", 1, 1, 9), ("hot", None, 9999, 5)]
    df = spark.createDataFrame(data, "k string, d int, t int, v int").repartition(4)
    window = Window.partitionBy("k").orderBy("d", *([tie] if tie else []))
    plain = df.withColumns({"prev_value": F.lag("v").over(window), "next_value": F.lead("v").over(window)})
    assert rows(with_neighbours(df, "k", "d", "v", tie), "k", "d", "t") == rows(plain, "k", "d", "t")
    assert rows(with_neighbours(df, "k", "d", "v", tie, block_rows=7), "k", "d", "t") == rows(plain, "k", "d", "t")
    # The same timeline with text dates, and with NULL keys.
    text = df.select(F.when(F.col("k") != "single", F.col("k")).alias("k"), F.date_add(F.lit("1990-01-01").cast("date"), "d").cast("string").alias("d"), "t", "v")
    window = Window.partitionBy("k").orderBy("d", *([tie] if tie else []))
    plain = text.withColumns({"prev_value": F.lag("v").over(window), "next_value": F.lead("v").over(window)})
    assert rows(with_neighbours(text, "k", "d", "v", tie), "k", "d", "t") == rows(plain, "k", "d", "t")


def test_neighbours_window_blocks_not_keys(spark):
    """One key with all rows in one year: no window over the key, one shuffle for the sort and one for the blocks."""
    df = spark.range(2000).select(F.lit("hot").alias("k"), (F.col("id") % 300).alias("d"), F.col("id").alias("t"), F.col("id").alias("v"))
    found = with_neighbours(df, "k", "d", "v", "t", block_rows=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(__block" in plan
    assert found.where("prev_value IS NULL").count() == found.where("next_value IS NULL").count() == 1
