import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from conftest import one, rows
from statforge.operators import quality as Q
from statforge.plans import bindings as B
from statforge.plans import checks
from statforge.plans.pipeline import GOLD_TABLES, SNAPSHOT_VIEWS, StageFailed, ingest, raise_failures, report_sources, run_pipeline
from statforge.plans.queries import write_raw
from statforge.sinks.files import Snapshot, child_dirs, delete_expired, refresh_all, retained, write_parquet
from statforge.sinks.findings import FindingsLog
from statforge.sinks.jdbc import JdbcTarget, load_tables
from statforge.sources.files import read_layer, scan_csv, source_inventory, verify_layer
from statforge.sources.kafka import kafka_options, sasl_ssl


def found(df):
    return {(r.table_name, r.rule): r.bad_rows for r in df.collect()}


def test_row_rules_ignore_nulls_and_respect_shares(spark):
    df = spark.createDataFrame([(1, 5), (-1, 5), (None, 0), (0, 0)], "a int, b int")
    rules = [Q.Rule("neg", "a < 0"), Q.holds("pos", "a >= 0"), Q.Rule("half", F.col("b") == 0, Q.WARNING, 0.5), Q.Rule("some", F.col("b") == 0, Q.WARNING, 0.4), *Q.not_null("a")]
    out = found(Q.check_rows(df, "t", rules))
    assert out == {("t", "neg"): 1, ("t", "pos"): 1, ("t", "half"): 0, ("t", "some"): 2, ("t", "a_not_null"): 1}
    text = Q.check_rows(df, "t", rules)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_constraints_have_a_violating_row_each(spark):
    """For every CHECK: one bad row is found, NULL passes."""
    bad = {
        "age": ("int", 13), "height": ("int", 221), "performance_score": ("double", 100.5), "market_score": ("double", -1.0),
        "health_score": ("double", 101.0), "overall_player_score": ("double", -0.1), "player_rank_percentile": ("double", 101.0),
        "injury_risk_level": ("string", "NONE"),
    }
    schema = ", ".join(f"{c} {k}" for c, (k, _) in bad.items())
    df = spark.createDataFrame([tuple(v for _, v in bad.values()), (None,) * len(bad)], schema)
    assert set(found(Q.check_rows(df, "t", checks.CONSTRAINTS["player_analytics_360"])).values()) == {1}
    matches = spark.createDataFrame([("IN_PLAY",), ("LIVE",), (None,)], "status string")
    assert found(Q.check_rows(matches, "m", checks.MATCH_CONSTRAINTS)) == {("m", "status_known"): 1}
    values = spark.createDataFrame([(1, 2, 3, 0), (-1, -1, -2, -1)], "peak_market_value int, lowest_market_value int, latest_market_value int, value_records_count int")
    assert found(Q.check_rows(values, "v", checks.CONSTRAINTS["market_value_trends"])) == {("v", f"{c}_positive"): 1 for c in ("peak_market_value", "latest_market_value", "lowest_market_value", "value_records_count")} | {("v", "peak_gte_lowest"): 1}


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (None,), (None,)], "k int")
    assert found(Q.duplicate_keys(df, "t", ["k"])) == {("t", "unique(k)"): 5}
    assert rows(Q.repeated_groups(df, ["k"]), "k") == [(None, 2), (1, 3)]
    parents = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert found(Q.check_references(df, "t", parents, {"k": "id"})) == {("t", "references(k)"): 3}
    out = one(Q.check_references(spark.range(0).selectExpr("cast(id as int) k"), "t", parents, {"k": "id"}))
    assert (out["bad_rows"], out["total_rows"]) == (0, 0)
    tables = {"leaderboards": spark.createDataFrame([(1, 1, "s", "T", 1, None, 1, "t"), (1, 1, "s", "T", 1, "", 1, "t")], "competition_id int, season_id int, stage string, standing_type string, team_id int, group_name string, position int, team_name string")}
    assert sum(found(checks.check_constraints(tables)).values()) == 2


def test_schema_and_size_rules(spark):
    df = spark.sql("select 1 i, cast(1.5 as decimal(10,4)) d, 'x' s")
    assert found(Q.required_columns(df, "t", ["i", "nope"])) == {("t", "has(i)"): 0, ("t", "has(nope)"): 1}
    assert found(Q.expected_families(df, "t", {"i": "int", "d": "int", "s": "date", "gone": "float"})) == {("t", "i is int"): 0, ("t", "d is int"): 1, ("t", "s is date"): 0, ("t", "gone is float"): 1}
    assert found(Q.expected_types(df, "t", {"d": "decimal(10,4)", "i": "bigint"})) == {("t", "d decimal(10,4)"): 0, ("t", "i bigint"): 1}
    assert [r.bad_rows for r in Q.combine([Q.check_size(df, "t", 1, 1), Q.check_size(df, "t", 2, 9), Q.not_empty(df, "t"), Q.not_empty(df.limit(0), "t")]).collect()] == [0, 1, 0, 1]


def test_profiles_and_counts(spark):
    df = spark.createDataFrame([(1, None), (0, None), (-2, "b")], "a int, b string")
    assert rows(Q.column_profile(df, "t").select("column_name", "null_rows", "null_pct", "high_missing")) == [("a", 0, 0.0, False), ("b", 2, 66.67, True)]
    assert rows(Q.value_counts(spark.createDataFrame([(v,) for v in "aabbc"] + [(None,)], "v string"), "v", 2)) == [("a", 2), ("b", 2)]
    out = one(Q.number_profile(df, "a"))
    assert (out["zero_rows"], out["negative_rows"], out["min_value"], out["max_value"], out["zero_pct"]) == (1, 1, -2.0, 1.0, 33.3)
    assert one(Q.number_profile(df.limit(0), "a"))["zero_pct"] is None


def test_verdict(spark):
    base = Q.check_rows(spark.range(3), "t", [Q.Rule("w", "id = 1", Q.WARNING), Q.Rule("ok", "id < 0")])
    assert one(Q.verdict(base)) == {"errors": 0, "warnings": 1, "rules": 2, "passed": True}
    worse = Q.combine([base, Q.check_rows(spark.range(3), "t", [Q.Rule("e", "id = 1")])])
    assert one(Q.verdict(worse))["passed"] is False


def test_source_rules(spark):
    raw = {
        "player_profiles": spark.createDataFrame([("1", "s", "n", "139", "2030-01-01"), ("1", "s", "n", "1.8", "1929-12-31"), ("2", "s", "n", "x", "?")], "player_id string, player_slug string, player_name string, height string, date_of_birth string"),
        "player_injuries": spark.createDataFrame([("2020-01-02", "2020-01-01", "-1"), ("2020-01-01", None, "5")], "from_date string, end_date string, days_missed string"),
        "transfer_history": spark.createDataFrame([("a", "a", "-5"), ("a", "b", "0"), ("a", None, "free")], "from_team_id string, to_team_id string, transfer_fee string"),
        "player_market_value": spark.createDataFrame([("0",), ("0",), ("-1",)], "value string"),
        "player_performances": spark.createDataFrame([("1", "-1", "10", "1", "2", "2"), ("9", "1", "2", "1", "0", "10")], "goals string, assists string, minutes_played string, yellow_cards string, second_yellow_cards string, penalty_goals string"),
    }
    out = {rule: bad for (_, rule), bad in found(checks.check_sources(raw, "2024-01-01")).items()}
    assert (out["height_unusual"], out["birth_in_future"], out["birth_before_1930"], out["unique(player_id)"]) == (2, 1, 1, 2)
    assert (out["ends_before_start"], out["days_missed_negative"], out["from_team_is_to_team"], out["transfer_fee_negative"], out["free_transfer"]) == (1, 1, 1, 1, 1)
    assert (out["value_mostly_zero"], out["value_negative"], out["assists_negative"]) == (2, 1, 1)
    # Text is compared as numbers: 10 penalties are more than 9 goals.
    assert (out["penalty_goals_above_goals"], out["second_yellow_above_yellow"]) == (2, 1)


# ---- sources and sinks -----------------------------------------------------------------------------


def put(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_with_line_breaks_only_where_needed(spark, folder):
    put(f"{folder}/a.csv", 'id,note\n1,"two\nlines"\n2,"say ""hi"""\n3,\n')
    put(f"{folder}/b.csv", "id,note\n4,plain\n5,\n")
    df = scan_csv(spark, folder)
    assert rows(df.select("id", "note"), "id") == [("1", "two\nlines"), ("2", 'say "hi"'), ("3", None), ("4", "plain"), ("5", None)]
    assert {r.bronze_source_file.rsplit("/", 1)[1] for r in df.select("bronze_source_file").distinct().collect()} == {"a.csv", "b.csv"}
    assert rows(scan_csv(spark, f"{folder}/b.csv", lineage=False), "id") == [("4", "plain"), ("5", None)]
    assert scan_csv(spark, f"{folder}/b.csv", infer=True, lineage=False).dtypes[0] == ("id", "int")
    assert rows(scan_csv(spark, f"{folder}/a.csv", "id int, note string", multi_line=True, lineage=False).where("id = 1")) == [(1, "two\nlines")]


def test_only_files_with_line_breaks_are_read_whole(spark, folder):
    put(f"{folder}/a b.csv", 'id,note\n1,"two\nlines"\n')
    put(f"{folder}/plain.csv", "id,note\n" + "".join(f"{i},x{i}\n" for i in range(2, 4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = scan_csv(spark, folder)
        got = rows(df.select("id", "note", F.element_at(F.split("bronze_source_file", "/"), -1).alias("file")).where("id < 3"), "id")
        assert got == [("1", "two\nlines", "a%20b.csv"), ("2", "x2", "plain.csv")] and df.count() == 3999
        # One task for the small file with a line break, several for the other.
        tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("bronze_source_file").alias("files")).collect()
        assert len(tasks) > 4 and all(len(t.files) == 1 for t in tasks)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_raw_tables_are_written_together(spark, folder, monkeypatch):
    """Each of the two tables waits for the other; a failing one is raised."""
    met = threading.Barrier(2, timeout=30)

    def meeting(name):
        def build(t):
            met.wait()
            return t.spark.createDataFrame([(name, 'a "b",\nc')], "player_id string, note string")

        return build

    def broken(t):
        raise ValueError("no such table")

    monkeypatch.setattr(B, "RAW", {"one": meeting("one"), "two": meeting("two"), "three": broken})
    write_raw(B.Tables(spark, folder), folder, ["one", "two"])
    for name in ("one", "two"):
        assert rows(scan_csv(spark, f"{folder}/{name}/{name}.csv", lineage=False)) == [(name, 'a "b",\nc')]
    with pytest.raises(ValueError, match="no such table"):
        write_raw(B.Tables(spark, folder), folder, ["three"])


def test_ingest_isolates_failures(spark, folder):
    import os

    os.makedirs(f"{folder}/raw/good")
    put(f"{folder}/raw/good/good.csv", "id\n1\n2\n")
    report = ingest(spark, f"{folder}/raw", f"{folder}/bronze", ["missing", "good"])
    assert [(r["table"], r["status"], r.get("rows")) for r in report] == [("missing", "FAILED", None), ("good", "SUCCESS", 2)]
    with pytest.raises(StageFailed, match="missing"):
        raise_failures("bronze", report)
    layer = verify_layer(spark, f"{folder}/bronze", ["good", "missing"])
    assert layer[0] == {"table": "good", "status": "OK", "rows": 2, "columns": 3} and layer[1]["status"] == "MISSING"
    files = source_inventory(spark, f"{folder}/raw", "*.csv", ["good.csv", "other.csv"])
    assert rows(files.select("file_name", "bytes", "present"), "file_name") == [("good.csv", 7, True), ("other.csv", None, False)]


def test_kafka_options():
    options = kafka_options("h:1", "matches", security=sasl_ssl("u", "p"), maxOffsetsPerTrigger="5")
    assert options["subscribe"] == "matches" and options["startingOffsets"] == "latest"
    assert options["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in options["kafka.sasl.jaas.config"]


def test_snapshots(spark, folder):
    snap = Snapshot(spark, folder, "mv")
    with pytest.raises(FileNotFoundError):
        snap.read()
    assert snap.refresh(spark.range(3)) == 3
    reader = snap.read()
    # A refresh may read the snapshot it replaces, and old readers go on.
    assert snap.refresh(snap.read().where("id > 0")) == 2
    assert (reader.count(), snap.read().count()) == (3, 2)
    snap.refresh(spark.range(9))
    assert snap.versions() == ["v=00000002", "v=00000003"]
    assert refresh_all(spark, folder, {"x": spark.range(2)}) == {"x": 2}


def test_retention(spark, folder):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + dt.timedelta(hours=6 * i)) for i in range(40)] + [(99, None)], "id int, ts timestamp")
    as_of = dt.datetime(2024, 1, 10, 7)
    kept = sorted(r[0] for r in retained(df, "ts", str(as_of)).select("id").collect())
    assert kept == [*range(10, 40), 99]
    write_parquet(df.withColumn("day", F.col("ts").cast("date")), f"{folder}/t", ["day"])
    assert delete_expired(spark, f"{folder}/t", "ts", "day", as_of) == 10
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/t").select("id").collect()) == kept
    assert delete_expired(spark, f"{folder}/t", "ts", "day", as_of) == 0
    assert delete_expired(spark, f"{folder}/t", "ts", "day", dt.datetime(2024, 1, 18)) == 30 - len([i for i in range(10, 40) if start + dt.timedelta(hours=6 * i) >= dt.datetime(2024, 1, 11)])
    assert "day=2024-01-10" not in child_dirs(spark, f"{folder}/t", committed=False)


def test_jdbc_plans(spark):
    target = JdbcTarget("jdbc:x", "analytics", {"user": "u", "driver": "d"}, batch_size=5, connections=3)
    assert target.options("t", keep_ddl=True) == {"url": "jdbc:x", "dbtable": "analytics.t", "batchsize": "5", "truncate": "true", "numPartitions": "3", "user": "u", "driver": "d"}
    written = []

    def write(df, target, name, keep_ddl):
        if name == "b":
            raise OSError("down")
        written.append((name, df.count(), keep_ddl))

    tables = {"a": spark.range(3), "b": spark.range(2), "c": spark.range(10)}
    report = load_tables(tables, target, ["a", "b", "zz"], keep_ddl=True, write=write)
    assert [r["status"] for r in report] == ["SUCCESS", "FAILED", "FAILED"] and written == [("a", 3, True)]
    report = load_tables(tables, target, None, write=write)
    assert [(r["table"], r["status"]) for r in report] == [("a", "SUCCESS"), ("b", "FAILED"), ("c", "SUCCESS")]


# ---- the whole pipeline -----------------------------------------------------------------------------


class Slice:
    """The smallest driver tables with fixed contents, for a quick end-to-end run."""

    def __init__(self, spark):
        self.spark = spark
        rng = random.Random(7)
        day = dt.datetime(1996, 1, 1)
        self.region = spark.createDataFrame([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string")
        self.nation = spark.createDataFrame([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int")
        self.customer = spark.createDataFrame([(i, f"C{i}", i % 2, 1.0, "SEG") for i in range(40)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
        self.supplier = spark.createDataFrame([(i, f"S{i}", i % 2, 1.0) for i in range(10)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
        self.orders = spark.createDataFrame([(i, rng.randrange(40), rng.choice("FOP"), 1000.0 * i, day + dt.timedelta(days=rng.randrange(900)), "1-URGENT") for i in range(200)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
        self.lineitem = spark.createDataFrame([(rng.randrange(200), rng.randrange(600), rng.randrange(10), rng.randrange(1, 8), 5.0, 1.0, 0.08, 0.06, rng.choice("ARN"), rng.choice("FO"), day) for i in range(600)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
        self.events = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 6, "error", 3.0, '{"k": 4}') for i in range(60)], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def test_pipeline_from_csv(spark, folder):
    t = Slice(spark)
    for name, build in B.RAW.items():
        build(t).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/raw/{name}/{name}.csv")
    stages = run_pipeline(spark, f"{folder}/raw", f"{folder}/out", B.AS_OF, expected_rows={"player_form_metrics": (1, 100)})
    assert list(stages) == ["bronze", "silver", "gold", "views", "validation"]
    assert {r["table"] for r in stages["gold"]["report"]} == set(GOLD_TABLES)
    assert stages["views"]["report"]["mvw_position_statistics"] >= 1
    verdict = stages["validation"]["report"]
    assert verdict["errors"] == 0 and verdict["passed"]
    log = FindingsLog(spark, f"{folder}/out/quality/results")
    assert log.runs() == [1] and {(t, "readable") for t in GOLD_TABLES} | {(v, "stored") for v in SNAPSHOT_VIEWS} <= set(found(log.read()))
    sources = report_sources(spark, f"{folder}/out/bronze", f"{folder}/out/quality/sources", B.AS_OF)
    assert sources["errors"] > 0 and found(FindingsLog(spark, f"{folder}/out/quality/sources").read())["player_profiles", "unique(player_id)"] == 10
    direct = B.profile_360(t)
    stored = read_layer(spark, f"{folder}/out/gold", "player_analytics_360")
    same = ["player_rank", "overall_player_score", "total_goals", "peak_market_value", "injury_risk_level", "total_transfer_fees"]
    assert rows(stored.select("player_id", *same), "player_id") == rows(direct.select("player_id", *same), "player_id")
    assert spark.table("vw_top_players").count() > 0
    with pytest.raises(StageFailed):
        run_pipeline(spark, f"{folder}/nothing", f"{folder}/out2")


def test_value_profile_and_families(spark):
    data = [("1", "2024-01-31", "2.50", 1.0, 7), (" 2.0 ", "2024-02-30", "x", 2.5, 8), ("1.5", None, "1e3", None, None), (None, None, None, None, 9)]
    df = spark.createDataFrame(data, "`a.i` string, d string, f string, x double, n bigint")
    families = {"a.i": Q.INT, "d": Q.DATE, "f": Q.FLOAT, "x": Q.INT, "gone": Q.INT}
    out = {r.column_name: r for r in Q.value_profile(df, "t", families).collect()}
    assert [out[c].misfit_rows for c in df.columns] == [1, 1, 1, 1, None]
    assert [out[c].null_pct for c in df.columns] == [25.0, 50.0, 25.0, 50.0, 25.0]
    assert (out["f"].min_value, out["f"].max_value, out["f"].mean_value) == (2.5, 1000.0, 501.25)
    assert (out["x"].min_value, out["x"].max_value, out["x"].mean_value) == (1.0, 2.5, 1.75)
    assert out["n"].family is None and out["n"].mean_value is None and out["d"].max_value is None
    empty = Q.value_profile(df.limit(0), "t", families).collect()
    assert len(empty) == 5 and all(r.total_rows == 0 and r.null_pct is None and r.mean_value is None and not r.high_missing for r in empty)
    plan = Q.value_profile(df, "t", families)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    rules = [*Q.missing_share("a.i", "d", over=0.4), *Q.family_rules(df, families)]
    assert set(found(Q.check_rows(df, "t", rules)).values()) == {0, 1, 2} and len(rules) == 6
    assert {r.table_name for r in Q.layer_profile({"p": df, "q": df}).collect()} == {"p", "q"}
    with pytest.raises(ValueError):
        Q.reads_as("d", "colour")


def test_source_findings_take_one_scan(spark, folder):
    spark.createDataFrame([("1", "s", None, "139", "2030-01-01")] * 3, "player_id string, player_slug string, player_name string, height string, date_of_birth string").write.parquet(f"{folder}/p")
    rest = {"team_children": spark.createDataFrame([(None,), ("1",), (None,)], "parent_team_id string")}
    out = found(checks.check_sources({"player_profiles": spark.read.parquet(f"{folder}/p"), **rest}, "2024-01-01"))
    assert out["player_profiles", "missing(player_name)"] == 3 and out["player_profiles", "missing(height)"] == 0
    assert out["team_children", "missing(parent_team_id)"] == 2 and out["player_profiles", "height reads as float"] == 0
    plan = checks.check_sources({"player_profiles": spark.read.parquet(f"{folder}/p")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # all row rules, and the unique key


def test_findings_log(spark, folder):
    log = FindingsLog(spark, f"{folder}/log")
    for read in (log.read, log.history, log.changes):
        with pytest.raises(FileNotFoundError):
            read()
    first = [("t", "fixed", Q.ERROR, 3, 9), ("t", "worse", Q.WARNING, 1, 9), ("t", "same", Q.INFO, 2, 9), ("t", "gone", Q.ERROR, 0, 9), ("t", "broken", Q.INFO, 0, 9), ("u", "better", Q.ERROR, 5, 9)]
    second = [("t", "fixed", Q.ERROR, 0, 8), ("t", "worse", Q.ERROR, 2, 8), ("t", "same", Q.INFO, 2, 8), ("t", "new", Q.ERROR, 1, 8), ("t", "broken", Q.INFO, 4, 8), ("u", "better", Q.ERROR, 4, 8)]
    assert log.record(spark.createDataFrame(first, Q.FINDING), dt.datetime(2024, 1, 1)) == 1
    assert {r.state for r in log.changes().collect()} == {"NEW"}
    assert log.record(spark.createDataFrame(second, Q.FINDING)) == 2
    out = {r.rule: r for r in log.changes().collect()}
    assert {rule: r.state for rule, r in out.items()} == {"fixed": "FIXED", "worse": "WORSE", "same": "SAME", "gone": "GONE", "broken": "BROKEN", "better": "BETTER", "new": "NEW"}
    assert (out["worse"].severity, out["worse"].previous_bad_rows, out["worse"].total_rows) == (Q.ERROR, 1, 8) and out["gone"].bad_rows is None
    assert log.history().groupBy("run").count().count() == 2 and log.read(1).count() == 6 and one(Q.verdict(log.read()))["errors"] == 3
    # A run that was lost before its commit is not seen, and its number is not used again.
    spark.createDataFrame(second, Q.FINDING).write.parquet(f"{folder}/log/run=00000003")
    import os

    os.remove(f"{folder}/log/run=00000003/_SUCCESS")
    assert log.runs() == [1, 2] and log.record(spark.createDataFrame(first, Q.FINDING)) == 4
    with pytest.raises(FileNotFoundError):
        log.read(3)


def test_stored_snapshots_and_layers_are_checked(spark, folder):
    snap = Snapshot(spark, folder, "mv")
    snap.refresh(spark.range(5))
    assert found(checks.check_snapshots(spark, folder, ["mv", "none"])) == {("mv", "stored"): 0, ("mv", "has_rows"): 0, ("mv", "rows_changed"): 0, ("none", "stored"): 1, ("none", "has_rows"): 1, ("none", "rows_changed"): 0}
    snap.refresh(spark.range(0))
    assert found(checks.check_snapshots(spark, folder, ["mv"])) == {("mv", "stored"): 0, ("mv", "has_rows"): 1, ("mv", "rows_changed"): 5}
    write_parquet(spark.range(4), f"{folder}/layer/a")
    out = {r.table_name: (r.bad_rows, r.total_rows) for r in checks.check_layer(spark, f"{folder}/layer", ["a", "b"]).collect()}
    assert out == {"a": (0, 4), "b": (1, 0)}


def test_declared_types_count_values_that_do_not_fit(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1L, 'A', 2147483648L, 1e9D), (2L, repeat('x', 256), 5L, 0.126D), (NULL, NULL, NULL, NULL)"
        " AS t(player_id, player_name, total_goals, performance_score)"
    )
    found = {r["rule"]: r["bad_rows"] for r in checks.check_declared(rows, "player_analytics_360").collect()}
    assert found["fits(player_id bigint)"] == 0
    assert found["fits(player_name varchar(255))"] == 1
    assert found["fits(total_goals int)"] == 1
    assert found["fits(performance_score decimal(10,2))"] == 1
    assert found["has(age int)"] == 3
    assert len(found) == len(checks.declared("player_analytics_360")) == 36
