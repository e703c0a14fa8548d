"""One row per key, chosen by a total order so that the choice never depends on partitioning.

``row_number() == 1`` is planned with a group limit before the shuffle: each map task keeps one row
per key, so a key that holds a third of all rows costs one row per task downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_RN = "__rn"


def _unorderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _unorderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_unorderable(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def tie_break(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Ascending order over every column not in ``skip``; maps are compared as JSON text."""
    order = []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        col = F.col(f"`{field.name}`")
        order.append((F.to_json(col) if _unorderable(field.dataType) else col).asc_nulls_last())
    return order


def first_by_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column] = (),
    total: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row of every key under ``order``.

    With ``total`` all columns but ``skip`` are appended as tie-break, so equal rows under ``order``
    still give one defined result. Pass ``total=False`` when ``order`` is already unique per key.
    """
    sort = list(order)
    if total:
        sort += tie_break(df, skip=[k for k in keys if isinstance(k, str)] + list(skip))
    # A table of nothing but keys has equal copies only; any of them will do.
    window = Window.partitionBy(*keys).orderBy(*(sort or [F.lit(0)]))
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def latest_by_key(df: DataFrame, keys: Sequence[str | Column], newest: str | Column, **kw) -> DataFrame:
    """Keep the newest row of every key; rows without a time are the oldest."""
    col = F.col(newest) if isinstance(newest, str) else newest
    return first_by_key(df, keys, [col.desc_nulls_last()], **kw)


def drop_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), **kw) -> DataFrame:
    """``dropDuplicates`` on a key subset with a defined survivor. NULL keys count as equal."""
    return first_by_key(df, keys, order, **kw)
