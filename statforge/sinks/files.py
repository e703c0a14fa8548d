"""Parquet tables, versioned snapshots and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> int:
    """Write a table and return its row count, observed during the write (no second job)."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["rows"]


# ---- small file-system helpers (listings and single directories, never data) --------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def child_dirs(spark: SparkSession, path: str, committed: bool = True) -> list[str]:
    """Names of the sub-directories, by default only those whose write was committed."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    if committed:
        names = [n for n in names if fs.exists(jpath(f"{path}/{n}/_SUCCESS"))]
    return sorted(names)


def drop_dir(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.delete(target, True)


# ---- snapshots ----------------------------------------------------------------------------------


class Snapshot:
    """A materialised result that can be refreshed while others read it.

    Every refresh writes a new version directory; readers take the newest committed one. The last
    ``keep`` versions stay so that running readers are not cut off.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, keep: int = 2):
        self.spark, self.path, self.name, self.keep = spark, f"{root.rstrip('/')}/{name}", name, keep

    def versions(self) -> list[str]:
        return [v for v in child_dirs(self.spark, self.path) if v.startswith("v=")]

    def refresh(self, df: DataFrame) -> int:
        """Store ``df`` as the new version and return its row count."""
        seen = child_dirs(self.spark, self.path, committed=False)
        number = 1 + max((int(v[2:]) for v in seen if v.startswith("v=")), default=0)
        rows = write_parquet(df, f"{self.path}/v={number:08d}", mode="overwrite")
        for old in self.versions()[: -self.keep]:
            drop_dir(self.spark, f"{self.path}/{old}")
        return rows

    def read(self, version: str | None = None) -> DataFrame:
        """The newest committed version, or one that ``versions`` names."""
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"snapshot {self.name} has no committed version below {self.path}")
        return self.spark.read.parquet(f"{self.path}/{version or versions[-1]}")


def refresh_all(spark: SparkSession, root: str, views: dict[str, DataFrame]) -> dict[str, int]:
    """Refresh every named snapshot; returns row counts."""
    return {name: Snapshot(spark, root, name).refresh(df) for name, df in views.items()}


# ---- retention ----------------------------------------------------------------------------------


def retained(df: DataFrame, time_column: str, as_of: dt.datetime | str | None = None, days: int = 7) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``. Rows without a time are kept."""
    kind = df.schema[time_column].dataType
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast(kind)
    expired = F.col(time_column) < now - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.where(~F.coalesce(expired, F.lit(False)))


def delete_expired(
    spark: SparkSession,
    path: str,
    time_column: str,
    date_partition: str,
    as_of: dt.datetime,
    days: int = 7,
) -> int:
    """Drop expired rows of a table partitioned by the date of ``time_column``; returns their number.

    Whole days go by deleting their directory; only the day holding the cut-off is rewritten, next to
    the table first and then swapped in by a dynamic partition overwrite. Other days are not touched.
    """
    cutoff = as_of - dt.timedelta(days=days)
    table = spark.read.parquet(path)
    day = F.col(date_partition).cast("date")
    old = table.where(day <= F.lit(str(cutoff.date())).cast("date"))
    kind = table.schema[time_column].dataType
    expired = F.col(time_column) < F.lit(str(cutoff)).cast(kind)
    deleted = old.where(expired).count()
    boundary = str(cutoff.date())
    names = [n for n in child_dirs(spark, path, committed=False) if n.startswith(f"{date_partition}=")]
    if f"{date_partition}={boundary}" in names and deleted:
        kept = old.where((day == F.lit(boundary).cast("date")) & ~F.coalesce(expired, F.lit(False)))
        staging = f"{path.rstrip('/')}.retention-{boundary}"
        if write_parquet(kept, staging):
            spark.read.parquet(staging).select(*table.columns).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(date_partition).parquet(path)
        else:
            drop_dir(spark, f"{path}/{date_partition}={boundary}")
        drop_dir(spark, staging)
    for name in names:
        value = name.split("=", 1)[1]
        if value[:1].isdigit() and value < boundary:
            drop_dir(spark, f"{path}/{name}")
    return deleted
