"""Time the headline queries and the batch stages, and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated names; default the headline set). Every query is run once to warm up,
then BENCH_RUNS times; its time is the median, with all result rows
consumed on the executors. The batch stages run on CSV files written from the same tables beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statforge.plans import bindings as B  # noqa: E402
from statforge.plans.pipeline import run_pipeline  # noqa: E402
from statforge.plans.queries import QUERIES, write_raw  # noqa: E402
from statforge.session import local_session, scratch  # noqa: E402

HEADLINE = (
    "clean_profiles clean_performances clean_values clean_injuries clean_transfers form_metrics value_summary "
    "value_timeline injury_risk transfer_intel profile_360 global_ranking partition_ranking drop_duplicates "
    "transfer_opportunities position_stats competition_rankings home_away current_live competition_live_summary "
    "json_match json_standings upsert_last_writer upsert_partial dq_findings"
).split()


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def exchanges(df) -> dict[str, int]:
    """Shuffles and broadcasts of the plan, apart."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    broadcasts = plan.count("BroadcastExchange ")
    return {"shuffles": plan.count("Exchange ") - broadcasts - plan.count("ReusedExchange "), "broadcasts": broadcasts}


def time_queries(spark, sf_dir: str, names: list[str], runs: int) -> tuple[dict[str, float], dict]:
    times, plans = {}, {}
    for name in names:
        warm = QUERIES[name](spark, sf_dir)
        consume(warm)
        plans[name] = exchanges(warm)
        taken: list[float] = []
        while len(taken) < runs:
            started = time.perf_counter()
            consume(QUERIES[name](spark, sf_dir))
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    return times, plans


def time_stages(spark, sf_dir: str) -> tuple[dict[str, float], dict]:
    """Seconds and rows per second of every pipeline stage, second run of two."""
    root = scratch(spark, "bench")
    write_raw(B.Tables(spark, sf_dir), f"{root}/raw", B.RAW)
    stages: dict[str, dict] = {}
    for attempt in ("first", "second"):
        stages = run_pipeline(spark, f"{root}/raw", f"{root}/{attempt}", B.AS_OF)
    times = {f"stage_{name}": stage["seconds"] for name, stage in stages.items()}
    rates = {}
    for name, stage in stages.items():
        if isinstance(stage["report"], list):
            rows = sum(entry["rows"] for entry in stage["report"])
            rates[f"stage_{name}"] = round(rows / stage["seconds"])
        print(f"stage_{name}: {stage['seconds']}", file=sys.stderr, flush=True)
    return times, rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, "statforge-bench")
    times, plans = time_queries(spark, sf_dir, chosen.split(",") if chosen else HEADLINE, runs)
    rates: dict[str, int] = {}
    if not chosen:
        stage_times, rates = time_stages(spark, sf_dir)
        times |= stage_times
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_and_stages_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "exchanges": plans,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
