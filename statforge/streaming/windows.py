"""Event-time windows over streams, closed by a watermark.

A window is counted while rows for it arrive and given out once, when the watermark (the latest time seen in earlier batches, less the allowed lateness)
has passed its end. Rows of windows that are closed already are late and are left out. Partial counts are the stream's state; they are in the
checkpoint, so a restart goes on with open windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed(rows: DataFrame, time: str, width: str, lateness: str, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None, slide: str | None = None) -> DataFrame:
    """``window_start``, ``window_end``, the columns ``by`` and ``measures`` (row counts by default) per window.

    ``rows`` may be a stream or a table; a table has no late rows and all its windows are given out. Rows without a time belong to no window.
    """
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = rows.withWatermark(time, lateness).groupBy(window, *by)
    counted = grouped.agg(*(c.alias(n) for n, c in (measures or {"rows": F.count(F.lit(1))}).items()))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *(c for c in counted.columns if c != "window"))


def start_windows(counted: DataFrame, out: str, checkpoint: str, trigger: str = "15 seconds", available_now: bool = False) -> StreamingQuery:
    """Append each closed window of ``counted``, a result of ``windowed``, to the Parquet table ``out``, once."""
    writer = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
