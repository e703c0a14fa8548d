"""Loading tables into a relational database over JDBC.

Everything goes through Spark's writer on the executors. A failed write raises; the multi-table
loaders record failures per table and finish the rest.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# The small dimension tables that are loaded by default.
RECOMMENDED = ("team_details", "team_children", "team_competitions_seasons")


@dataclass(frozen=True)
class JdbcTarget:
    """Where and how to write. ``connections`` bounds how many tasks write at once."""

    url: str
    schema: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    connections: int | None = None

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def options(self, name: str, keep_ddl: bool) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table(name), "batchsize": str(self.batch_size)}
        if keep_ddl:
            options["truncate"] = "true"
        if self.connections:
            options["numPartitions"] = str(self.connections)
        return options | dict(self.properties)


def write_jdbc(df: DataFrame, target: JdbcTarget, name: str, keep_ddl: bool = False, mode: str = "overwrite") -> None:
    """Write one table. ``keep_ddl`` empties an existing table instead of recreating it."""
    df.write.format("jdbc").options(**target.options(name, keep_ddl)).mode(mode).save()


def load_tables(
    tables: Mapping[str, DataFrame],
    target: JdbcTarget,
    names: Sequence[str] | None = RECOMMENDED,
    keep_ddl: bool = False,
    counts: Mapping[str, int] | None = None,
    write: Callable[..., None] = write_jdbc,
) -> list[dict]:
    """Load the named tables (all when ``names`` is None) and report each one."""
    report = []
    for name in tables if names is None else names:
        started = time.monotonic()
        try:
            df = tables[name]
            rows = counts[name] if counts and name in counts else df.count()
            write(df, target, name, keep_ddl)
            report.append(
                {"table": name, "status": "SUCCESS", "rows": rows, "seconds": time.monotonic() - started}
            )
        except Exception as error:  # noqa: BLE001 - one table must not stop the others
            report.append({"table": name, "status": "FAILED", "error": str(error)})
    return report
