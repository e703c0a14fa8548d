"""One view over a batch layer and a stream's current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.operators.dedup import first_by_key
from statforge.operators.upsert import _key_columns
from statforge.streaming.store import UpsertTable

_LAYER = "_layer"


def merged_view(batch: DataFrame, table: UpsertTable) -> DataFrame:
    """The newest row of every key in ``batch`` or ``table``, with the columns of the table; of equally new ones, the table's.

    Only committed batches of the table are read, so the view may be taken while a stream writes and while the table is compacted. Columns
    that the batch layer lacks are NULL there. The table must name the column that orders its changes.
    """
    if table.newest is None:
        raise ValueError("a merged view needs a table with a column that orders its changes")
    current = table.current()
    both = batch.select(*(c for c in current.columns if c in batch.columns)).withColumn(_LAYER, F.lit(0))
    both = current.withColumn(_LAYER, F.lit(1)).unionByName(both, allowMissingColumns=True)
    order = [F.col(table.newest).desc_nulls_last(), F.col(_LAYER).desc()]
    return first_by_key(both, _key_columns(table.keys, table.blank_null), order).drop(_LAYER)
