"""Ranks that never sort a whole table, or a whole hot partition, in one task.

Rows are range-partitioned by their full sort order, with a hash as last key so that equal rows spread, and stored. A row's number
in the whole order follows from its place in its task and the row counts of the tasks before, one number per task. A rank is then
the difference of two row numbers: those of the first row with equal sort values and of the first row of the partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.session import stored

_LOCAL_BITS = 33  # of monotonically_increasing_id()


def numbered(df: DataFrame, order: Sequence[Column], out: str = "__number") -> DataFrame:
    """``df`` with each row's number, from 0, in the given order. The sorted rows are written once."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    placed = stored(placed, "sorted")
    task = F.shiftright("__row", _LOCAL_BITS)
    counts = sorted((row["task"], row["count"]) for row in placed.groupBy(task.alias("task")).count().collect())
    before = accumulate((n for _, n in counts), initial=0)
    offsets = df.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(counts, before)], "__task bigint, __before bigint")
    inside = F.col("__row").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # One row per task of the sort.
    found = placed.join(F.broadcast(offsets), task == F.col("__task"))
    return found.withColumn(out, F.col("__before") + inside).drop("__row", "__task", "__before")


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of the pairs of columns; NULL equals NULL."""
    return reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs), F.lit(True))


def _first_number(rows: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """``rows`` with the least row number among rows that are equal in ``by`` (NULL equals NULL)."""
    least = rows.groupBy(*(F.col(c).alias(f"__{out}{i}") for i, c in enumerate(by))).agg(F.min("__number").alias(out))
    return rows.join(least, _same([(c, f"__{out}{i}") for i, c in enumerate(by)])).drop(*(f"__{out}{i}" for i in range(len(by))))


def _spread(df: DataFrame) -> Column:
    """A hash over the plain columns, to deal out equal sort values."""
    plain = [f"`{c}`" for c, kind in df.dtypes if not kind.startswith(("map", "array", "struct", "variant"))]
    return F.xxhash64(*plain)


def partition_rank(df: DataFrame, parts: Sequence[str], best_first: Sequence[str], out: str = "rank") -> DataFrame:
    """``RANK()`` over (partition by ``parts`` order by every ``best_first`` column descending). NULL sort values are ranked last."""
    order = [*(F.col(p).asc_nulls_first() for p in parts), *(F.col(c).desc_nulls_last() for c in best_first)]
    rows = numbered(df.withColumn("__spread", _spread(df)), [*order, F.col("__spread").asc()])
    keys = [*parts, *best_first]
    # Both first numbers come from the distinct sort values, so the rows themselves are joined once.
    tied = rows.groupBy(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(keys))).agg(F.min("__number").alias("__tied"))
    start = tied.groupBy(*(F.col(f"__k{i}").alias(f"__p{i}") for i in range(len(parts)))).agg(F.min("__tied").alias("__start"))
    places = tied.join(start, _same([(f"__k{i}", f"__p{i}") for i in range(len(parts))])).select(
        *(f"__k{i}" for i in range(len(keys))), (F.col("__tied") - F.col("__start") + 1).cast("int").alias("__place")
    )
    placed = rows.join(places, _same([(c, f"__k{i}") for i, c in enumerate(keys)]))
    return placed.select(*df.columns, F.col("__place").alias(out))


def global_rank(
    df: DataFrame,
    score: str,
    ident: str,
    rank_col: str = "rank",
    percent_col: str = "rank_percentile",
    digits: int | None = 2,
) -> DataFrame:
    """Row number and ``percent_rank`` over the whole table, best score first.

    Equal scores are ordered by ``md5(ident)`` and then ``ident``: any total order is a valid answer, and this one can be cut into
    even ranges whatever the ids look like. NULL scores rank last. The percentile is 0 for the best row.
    """
    digest = F.coalesce(F.md5(F.col(ident).cast("string")), F.lit(""))
    # A plain value instead of NULL, so that ties are joined on a number.
    rows = df.select("*", digest.alias("__md5"), F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))).alias("__sort"))
    rows = numbered(rows, [F.col("__sort").desc(), F.col("__md5").asc(), F.col(ident).asc_nulls_last()])
    total = rows.count()
    rows = _first_number(rows, ["__sort"], "__best")
    share = F.col("__best") / F.lit(float(total - 1)) if total > 1 else F.lit(0.0)
    return rows.select(
        *(F.col(c) for c in df.columns),
        (F.col("__number") + 1).cast("bigint").alias(rank_col),
        (F.round(share, digits) if digits is not None else share).alias(percent_col),
    )
