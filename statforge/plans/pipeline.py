"""The batch jobs: raw CSV to bronze, silver and gold Parquet, loads, views and validation."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from statforge.operators import quality as Q
from statforge.plans import checks, metrics, views
from statforge.plans.silver import SILVER, clean_table
from statforge.sinks.files import refresh_all, write_parquet
from statforge.sinks.findings import FindingsLog
from statforge.sinks.jdbc import RECOMMENDED, JdbcTarget, load_tables
from statforge.sources.files import INGESTED_AT, SOURCE_FILE, read_layer, scan_csv, text_schema, verify_layer

# The raw tables, each in a folder of its own name, and their columns where known.
RAW_TABLES = (
    "player_profiles",
    "player_performances",
    "player_market_value",
    "player_latest_market_value",
    "player_injuries",
    "player_national_performances",
    "player_teammates_played_with",
    "team_details",
    "team_competitions_seasons",
    "team_children",
    "transfer_history",
)
GOLD_TABLES = (
    "player_form_metrics",
    "market_value_trends",
    "injury_risk_scores",
    "transfer_intelligence",
    "player_analytics_360",
)
SNAPSHOT_VIEWS = ("mvw_position_statistics", "mvw_age_group_analysis")


class StageFailed(RuntimeError):
    """A stage finished its other tables, but some failed."""

    def __init__(self, stage: str, report: Sequence[dict]):
        failed = [f"{r['table']}: {r.get('error')}" for r in report if r["status"] == "FAILED"]
        super().__init__(f"{stage}: {len(failed)} failed - " + "; ".join(failed))
        self.report = list(report)


def _each(spark: SparkSession, names: Sequence[str], work: Callable[[str], int], at_once: int = 4) -> list[dict]:
    """Run ``work`` for every table; a failure is recorded and the rest go on.

    Up to ``at_once`` tables are submitted together, so that small ones fill the cluster while a
    large one finishes.
    """

    def one(name: str) -> dict:
        started = time.monotonic()
        try:
            rows = work(name)
            return {"table": name, "status": "SUCCESS", "rows": rows, "seconds": time.monotonic() - started}
        except Exception as error:  # noqa: BLE001 - reported per table
            return {"table": name, "status": "FAILED", "error": str(error)}

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), names))


def raise_failures(stage: str, report: list[dict]) -> list[dict]:
    if any(r["status"] == "FAILED" for r in report):
        raise StageFailed(stage, report)
    return report


def ingest(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    tables: Sequence[str] = RAW_TABLES,
    columns: Mapping[str, Sequence[str]] | None = None,
    **scan,
) -> list[dict]:
    """Raw CSV to bronze Parquet, one read and one job per table."""

    def one(name: str) -> int:
        schema = text_schema(tuple(columns[name])) if columns and name in columns else None
        rows = scan_csv(spark, f"{raw_root.rstrip('/')}/{name}/{name}.csv", schema, **scan)
        return write_parquet(rows, f"{bronze_root.rstrip('/')}/{name}")

    return _each(spark, tables, one)


def clean_all(
    spark: SparkSession, bronze_root: str, silver_root: str, tables: Sequence[str] | None = None
) -> list[dict]:
    """Bronze to silver."""

    def one(name: str) -> int:
        return write_parquet(clean_table(name, read_layer(spark, bronze_root, name)), f"{silver_root.rstrip('/')}/{name}")

    return _each(spark, tuple(SILVER) if tables is None else tables, one)


def compute_gold(
    spark: SparkSession, silver_root: str, gold_root: str, as_of: dt.date | str | None = None
) -> list[dict]:
    """Silver to gold. The four metrics are written first and read back for the combined profile."""

    def silver(name: str) -> DataFrame:
        return read_layer(spark, silver_root, name)

    def gold(name: str) -> DataFrame:
        return read_layer(spark, gold_root, name)

    plans: dict[str, Callable[[], DataFrame]] = {
        "player_form_metrics": lambda: metrics.form_metrics(silver("player_performances")),
        "market_value_trends": lambda: metrics.value_summary(silver("player_market_value")),
        "injury_risk_scores": lambda: metrics.injury_risk(silver("player_injuries")),
        "transfer_intelligence": lambda: metrics.transfer_intelligence(silver("transfer_history")),
        "player_analytics_360": lambda: metrics.profile_360(
            silver("player_profiles"), *(gold(t) for t in GOLD_TABLES[:4]), as_of=as_of
        ),
    }
    def one(name: str) -> int:
        return write_parquet(plans[name](), f"{gold_root.rstrip('/')}/{name}")

    return _each(spark, GOLD_TABLES[:4], one) + _each(spark, GOLD_TABLES[4:], one)


def report_sources(spark: SparkSession, bronze_root: str, log_root: str, as_of: dt.date | str | None = None) -> dict:
    """Check the raw tables as they were ingested, keep the findings as a run of the log and return the verdict."""
    report = verify_layer(spark, bronze_root, list(RAW_TABLES))
    raw = {r["table"]: read_layer(spark, bronze_root, r["table"]).drop(INGESTED_AT, SOURCE_FILE) for r in report if r["status"] == "OK"}
    log = FindingsLog(spark, log_root)
    log.record(Q.combine([checks.check_sources(raw, as_of), checks.check_layer(spark, bronze_root, RAW_TABLES)]))
    return Q.verdict(log.read()).first().asDict()


def run_pipeline(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    as_of: dt.date | str | None = None,
    jdbc: JdbcTarget | None = None,
    columns: Mapping[str, Sequence[str]] | None = None,
    expected_rows: Mapping[str, tuple[int, int]] | None = None,
    tables: Sequence[str] = RAW_TABLES,
) -> dict[str, dict]:
    """All stages in order with their time and report; the first failing stage raises.

    Without ``jdbc`` the two load stages are skipped. A failed validation is reported, not raised.
    """
    out = out_root.rstrip("/")
    bronze, silver_root, gold_root = f"{out}/bronze", f"{out}/silver", f"{out}/gold"
    stages: dict[str, dict] = {}

    def stage(name: str, work: Callable[[], object]) -> None:
        started = time.monotonic()
        result = work()
        if isinstance(result, list):
            raise_failures(name, result)
        stages[name] = {"seconds": round(time.monotonic() - started, 3), "report": result}

    def gold() -> dict[str, DataFrame]:
        return {t: read_layer(spark, gold_root, t) for t in GOLD_TABLES}

    def silver() -> dict[str, DataFrame]:
        return {t: read_layer(spark, silver_root, t) for t in SILVER if t in tables}

    def make_views() -> dict[str, int]:
        named = views.build_player_views(gold())
        views.register_all(spark, named)
        return refresh_all(spark, f"{out}/snapshots", {n: named[n] for n in SNAPSHOT_VIEWS})

    def validation() -> dict:
        named = views.build_player_views(gold())
        found = [
            checks.validate(gold(), silver(), named, expected_rows),
            checks.check_layer(spark, gold_root, GOLD_TABLES),
            checks.check_snapshots(spark, f"{out}/snapshots", SNAPSHOT_VIEWS),
        ]
        # One row per rule; every run is kept, and the verdict comes from what was stored.
        log = FindingsLog(spark, f"{out}/quality/results")
        log.record(Q.combine(found))
        return Q.verdict(log.read()).first().asDict()

    stage("bronze", lambda: ingest(spark, raw_root, bronze, tables, columns))
    stage("silver", lambda: clean_all(spark, bronze, silver_root, [t for t in SILVER if t in tables]))
    stage("gold", lambda: compute_gold(spark, silver_root, gold_root, as_of))
    if jdbc is not None:
        stage("load_silver", lambda: load_tables(silver(), jdbc, RECOMMENDED))
        stage("load_gold", lambda: load_tables(gold(), jdbc, None, keep_ddl=True))
    stage("views", make_views)
    stage("validation", validation)
    return stages
