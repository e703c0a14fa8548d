"""A history of quality findings: every check is a numbered run, and runs can be compared."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.operators.quality import FINDING
from statforge.sinks.files import child_dirs, write_parquet

NEW, GONE, FIXED, BROKEN, WORSE, BETTER, SAME = "NEW", "GONE", "FIXED", "BROKEN", "WORSE", "BETTER", "SAME"


class FindingsLog:
    """Findings stored below ``root`` as ``run=<n>``; a run counts once Spark has committed it, and none is ever changed.

    Numbers of lost runs are not used again. Runs take turns: there are no concurrent writers.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def runs(self) -> list[int]:
        """Numbers of the committed runs, ascending."""
        return sorted(int(name[4:]) for name in child_dirs(self.spark, self.root) if name.startswith("run="))

    def record(self, findings: DataFrame, at: dt.datetime | None = None) -> int:
        """Store one run, with the time it was made (by default now), and return its number."""
        seen = child_dirs(self.spark, self.root, committed=False)
        number = 1 + max((int(name[4:]) for name in seen if name.startswith("run=")), default=0)
        time = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
        columns = [part.split()[0] for part in FINDING.split(", ")]
        write_parquet(findings.select(*columns, time.alias("checked_at")), f"{self.root}/run={number:08d}")
        return number

    def read(self, run: int | None = None) -> DataFrame:
        """Findings of one run, by default the last."""
        runs = self.runs()
        wanted = run if run is not None else (runs[-1] if runs else None)
        if wanted not in runs:
            raise FileNotFoundError(f"no run {wanted or ''} below {self.root}")
        return self.spark.read.parquet(f"{self.root}/run={wanted:08d}")

    def history(self) -> DataFrame:
        """All committed runs with their number in ``run``."""
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"no run below {self.root}")
        paths = [f"{self.root}/run={n:08d}" for n in runs]
        return self.spark.read.option("basePath", self.root).parquet(*paths).withColumn("run", F.col("run").cast("bigint"))

    def changes(self) -> DataFrame:
        """Every rule of the last two runs with its counts in both and what became of it.

        ``NEW``: not checked before; ``GONE``: not checked any more; ``FIXED`` and ``BROKEN``: to or from no bad rows; otherwise ``WORSE``,
        ``BETTER`` or ``SAME`` by the number of bad rows. After one run everything is ``NEW``. A rule found twice in a run counts once, by
        its largest numbers.
        """
        runs = self.runs()
        last, before = (runs[-1], runs[-2] if len(runs) > 1 else None) if runs else (None, None)
        now, old = F.col("run") == last, (F.col("run") == before) if before is not None else F.lit(False)
        pair = self.history().where(now | old)
        grouped = pair.groupBy("table_name", "rule").agg(
            F.max(F.when(now, F.col("severity"))).alias("__now"),
            F.max("severity").alias("severity"),
            F.max(F.when(old, F.col("bad_rows"))).alias("previous_bad_rows"),
            F.max(F.when(now, F.col("bad_rows"))).alias("bad_rows"),
            F.max(F.when(old, F.col("total_rows"))).alias("previous_total_rows"),
            F.max(F.when(now, F.col("total_rows"))).alias("total_rows"),
        )
        bad, was = F.col("bad_rows"), F.col("previous_bad_rows")
        state = (
            F.when(was.isNull(), NEW)
            .when(bad.isNull(), GONE)
            .when((was > 0) & (bad == 0), FIXED)
            .when((was == 0) & (bad > 0), BROKEN)
            .when(bad > was, WORSE)
            .when(bad < was, BETTER)
            .otherwise(SAME)
        )
        severity = F.coalesce("__now", "severity").alias("severity")
        return grouped.select("table_name", "rule", severity, "previous_bad_rows", "bad_rows", "previous_total_rows", "total_rows", state.alias("state"))
