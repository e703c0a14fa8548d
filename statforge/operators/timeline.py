"""Previous and next value along each entity's timeline, however long one timeline is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statforge.operators.ranking import numbered

BLOCK_ROWS = 8192


def with_neighbours(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    tie: str | None = None,
    previous: str = "prev_value",
    following: str = "next_value",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``lag(value)`` and ``lead(value)`` per ``key`` ordered by ``order`` (then ``tie``, then a hash of the value).

    Rows are range-sorted by key and order over all tasks and numbered; their numbers are cut into blocks of ``block_rows``. A block also
    holds the last row of the block before and the first row of the next one, so each is windowed alone, and no group depends on how many rows a key has.
    """
    sort = [F.col(key).asc_nulls_first(), F.col(order).asc_nulls_first()] + ([F.col(tie).asc_nulls_first()] if tie else [])
    rows = numbered(df.withColumn("__spread", F.xxhash64(value)), [*sort, F.col("__spread").asc()])
    own, at = F.floor(F.col("__number") / block_rows), F.col("__number") % block_rows
    beside = F.concat(F.array(own), F.when(at == 0, F.array(own - 1)).otherwise(F.array()), F.when(at == block_rows - 1, F.array(own + 1)).otherwise(F.array()))
    dealt = rows.withColumn("__own", own).withColumn("__block", F.explode(beside))
    inside = Window.partitionBy("__block").orderBy("__number")
    row = F.struct(F.col(key).alias("key"), F.col(value).alias("value"))
    placed = dealt.withColumns({"__lag": F.lag(row).over(inside), "__lead": F.lead(row).over(inside)}).where("__own = __block")

    def of_same(found: str):
        return F.when(F.col(found)["key"].eqNullSafe(F.col(key)), F.col(found)["value"])

    return placed.select(*df.columns, of_same("__lag").alias(previous), of_same("__lead").alias(following))
