"""Registered queries: every operator and job on the driver's tables, always on whole tables.

Results are made comparable across engines: dates and times as text, integers as bigint, decimals as
double.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryException

from statforge.functions import expr as E
from statforge.functions import messages as M
from statforge.operators import quality as Q
from statforge.operators import upsert as U
from statforge.operators.dedup import drop_repeats, latest_by_key
from statforge.operators.ranking import global_rank, partition_rank
from statforge.plans import bindings as B
from statforge.plans import checks, metrics, views
from statforge.plans.bindings import Tables
from statforge.plans.pipeline import ingest, raise_failures, run_pipeline
from statforge.session import scratch, stored
from statforge.sinks.files import Snapshot, delete_expired, retained, write_parquet
from statforge.sinks.findings import FindingsLog
from statforge.sinks.jdbc import JdbcTarget, load_tables
from statforge.sources.files import SOURCE_FILE, competitions_file, read_layer, verify_layer
from statforge.sources.files import standings_dir as read_standings
from statforge.streaming.jobs import COMPETITIONS, MATCHES, STANDINGS, load_standings_files, run_until_done, start_upserts, upsert_batches
from statforge.streaming.serving import merged_view
from statforge.streaming.windows import start_windows, windowed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FILE_MESSAGES = 1000
# Messages of one file of a topic: Spark reads at most some thirty such small files in one task, so what a task sorts is bounded.
TOPIC_FILE_MESSAGES = 25_000


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(work: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the driver's tables under its own name."""

    @wraps(work)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(work(Tables(spark, sf_dir)))

    QUERIES[work.__name__] = run
    return work


# ---- metrics ------------------------------------------------------------------------------------


@query
def form_metrics(t):
    return B.metric(t, "player_form_metrics")


@query
def value_summary(t):
    return B.metric(t, "market_value_trends")


@query
def value_change(t):
    return metrics.value_change(B.silver(t, "player_market_value"), "1998-06-30", audit=False)


@query
def recent_form(t):
    return metrics.recent_form(B.silver(t, "player_performances"), audit=False)


@query
def value_timeline(t):
    return metrics.value_timeline(B.silver(t, "player_market_value"))


@query
def injury_risk(t):
    return B.metric(t, "injury_risk_scores")


@query
def transfer_intel(t):
    return B.metric(t, "transfer_intelligence")


@query
def left_chain_join(t):
    metric = [B.metric(t, name) for name in B.METRICS]
    joined = metrics.join_metrics(B.silver(t, "player_profiles").select("player_id", "player_name"), *metric)
    return joined.select(
        "player_id", "player_name", "total_seasons", "value_records_count", "total_injuries", "total_transfers"
    )


@query
def profile_scores(t):
    metric = [B.metric(t, name) for name in B.METRICS]
    scored = metrics.add_scores(metrics.join_metrics(B.silver(t, "player_profiles").select("player_id"), *metric))
    return scored.select("player_id", "performance_score", "market_score", "health_score", "overall_player_score")


@query
def profile_360(t):
    return B.profile_360(t)


# ---- ranks, windows, duplicates ----------------------------------------------------------------------


@query
def global_ranking(t):
    scored = t.orders.select("o_orderkey", F.round(F.col("o_totalprice") / 5000, 2).alias("score"))
    return global_rank(scored, "score", "o_orderkey", "position", "percentile", digits=None)


@query
def partition_ranking(t):
    rows = t.lineitem.groupBy("l_orderkey", "l_suppkey", "l_returnflag").agg(
        F.sum("l_quantity").cast("int").alias("quantity"), F.count(F.lit(1)).alias("lines")
    )
    return partition_rank(rows, ["l_suppkey", "l_returnflag"], ["quantity", "lines"], "place")


@query
def latest_event_by_user(t):
    return latest_by_key(t.events.select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], "ts")


@query
def drop_duplicates(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return drop_repeats(rows, ["l_orderkey", "l_linenumber"])


# ---- cleaning -----------------------------------------------------------------------------------------


def _cleaning(query_name: str, table: str) -> None:
    def run(t):
        return B.silver(t, table)

    run.__name__ = query_name
    query(run)


for _query_name, _table in (
    ("clean_profiles", "player_profiles"),
    ("clean_performances", "player_performances"),
    ("clean_values", "player_market_value"),
    ("clean_injuries", "player_injuries"),
    ("clean_transfers", "transfer_history"),
    ("clean_teams", "team_details"),
    ("clean_national", "player_national_performances"),
    ("clean_teammates", "player_teammates_played_with"),
    ("clean_team_seasons", "team_competitions_seasons"),
    ("clean_team_children", "team_children"),
):
    _cleaning(_query_name, _table)


@query
def height_normalise(t):
    height = F.concat((F.col("c_custkey") % 300).cast("string"), F.lit(".0"))
    metres = F.concat(F.lit("1."), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"))
    rows = t.customer.select("c_custkey", height.alias("height"), metres.alias("metres"))
    return rows.select(
        "c_custkey",
        E.height_cm("height").alias("height_cm"),
        E.height_cm("metres").alias("truncated_cm"),
        E.height_cm("metres", nearest=True).alias("nearest_cm"),
    )


@query
def utc_shift(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("event_id") % 17 == 0, F.lit("not a time")).otherwise(iso)
    rows = t.events.select("event_id", text.alias("iso"))
    return rows.select("event_id", E.iso_utc("iso").alias("utc"), E.in_zone(E.iso_utc("iso"), M.MATCH_ZONE).alias("local"))


# ---- joins, aggregates --------------------------------------------------------------------------------


@query
def anti_join_orphans(t):
    return Q.orphans(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"})


@query
def conditional_sums(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(F.col("o_orderstatus") == "F").alias("wins"),
        F.count_if((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)).alias("big_open"),
    )


@query
def count_distinct_users(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("value") > 50).alias("large"),
    )


@query
def having_duplicates(t):
    return Q.repeated_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def duplicate_members(t):
    return Q.duplicate_keys(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])


@query
def null_profile(t):
    rows = B.silver(t, "player_profiles").select("player_id", "player_name", "height").join(
        B.metric(t, "injury_risk_scores").select("player_id", "total_injuries", "injury_risk_level"), "player_id", "left"
    )
    return Q.column_profile(rows, "players")


@query
def value_counts_top10(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return Q.value_counts(rows, "n_name", 10)


@query
def global_aggregate(t):
    return Q.number_profile(t.lineitem.withColumn("l_discount", F.col("l_discount") + 0.0), "l_quantity").select(
        "total_rows", "zero_rows", "negative_rows", "min_value", "max_value", F.round("mean_value", 6).alias("mean_value"), "zero_pct"
    )


@query
def union_counts(t):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return views.row_counts({n: getattr(t, n) for n in names})


# ---- player views ----------------------------------------------------------------------------------------


@query
def top_players(t):
    return views.top_players(B.profile_360(t))


@query
def high_value_low_risk(t):
    return views.high_value_low_risk(B.scored_profile(t))


@query
def transfer_opportunities(t):
    return views.transfer_opportunities(B.scored_profile(t), B.metric(t, "transfer_intelligence"))


def _rounded(df: DataFrame) -> DataFrame:
    """Averages at a precision that does not depend on the order of summation."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*(F.round(c, 4).alias(c) if c in doubles else c for c in df.columns))


@query
def position_stats(t):
    return _rounded(views.position_statistics(B.scored_profile(t)))


@query
def age_groups(t):
    return _rounded(views.age_group_analysis(B.scored_profile(t)))


@query
def four_way_join(t):
    parts = B.gold(t)
    return views.reliable_scorers(
        parts["player_analytics_360"],
        parts["player_form_metrics"],
        parts["injury_risk_scores"],
        parts["market_value_trends"],
        goals=3,
    )


@query
def young_opportunities(t):
    return views.young_opportunities(transfer_opportunities(t), below_age=28)


@query
def valuable_safe_players(t):
    return views.valuable_safe_players(views.high_value_low_risk(B.scored_profile(t)))


@query
def positions_by_score(t):
    return _rounded(views.positions_by_score(views.position_statistics(B.scored_profile(t))))


@query
def positions_by_size(t):
    return _rounded(views.positions_by_size(views.position_statistics(B.scored_profile(t))))


# ---- standings --------------------------------------------------------------------------------------------


def _leaderboards(t: Tables) -> DataFrame:
    """The standings as a stored table, as the serving views find them."""
    return stored(B.standings(t), "leaderboards")


def _competitions(t: Tables) -> DataFrame:
    """The competitions as a stored table, likewise."""
    return stored(B.competitions(t), "competitions")


@query
def league_table(t):
    return B.standings(t)


@query
def current_standings(t):
    return views.current_standings(_leaderboards(t), _competitions(t))


@query
def top_teams(t):
    return views.top_teams(_leaderboards(t), _competitions(t))


@query
def conditional_left_join(t):
    return views.competition_summary(_leaderboards(t), _competitions(t))


@query
def home_away(t):
    return views.home_away(_leaderboards(t), _competitions(t))


@query
def competition_rankings(t):
    return views.competition_rankings(_leaderboards(t), _competitions(t), audit=False)


@query
def standings_filters(t):
    return views.standings_of(_leaderboards(t), competition_code="AS", group_name="Group A")


@query
def best_by_points(t):
    return views.best_by_points(_leaderboards(t))


@query
def rankings_filter(t):
    ranked = views.competition_rankings(_leaderboards(t), _competitions(t), audit=False)
    return views.rankings_of(ranked, "AM")


@query
def snapshot_refresh(t):
    """Refresh a snapshot twice; readers see the second version."""
    stored = Snapshot(t.spark, scratch(t.spark, "snapshots"), "mv_competition_rankings")
    ranked = views.competition_rankings(_leaderboards(t), _competitions(t), audit=False)
    stored.refresh(ranked.withColumn("overall_rank", -F.col("overall_rank")))
    stored.refresh(ranked)
    return stored.read()


# ---- live events ---------------------------------------------------------------------------------------------


@query
def current_live(t):
    return views.current_live(B.live_events(t))


@query
def score_progression(t):
    return views.score_progression(B.live_events(t))


@query
def competition_live_summary(t):
    return views.competition_live_summary(B.live_events(t))


@query
def interval_filter(t):
    return views.recent_events(B.live_events(t), "2024-01-20 12:00:00", "6 hours")


@query
def retention(t):
    return retained(t.events.select("event_id", "ts", "user_id"), "ts", "2024-01-20 12:00:00", 7)


@query
def retention_delete(t):
    """Events stored by day, expired days deleted, the cut-off day rewritten."""
    import datetime as dt

    path = scratch(t.spark, "retention")
    rows = t.events.select("event_id", "ts", "user_id", F.col("ts").cast("date").alias("day"))
    write_parquet(rows.repartition("day"), path, ["day"])
    gone = delete_expired(t.spark, path, "ts", "day", dt.datetime(2024, 1, 20, 12), 7)
    left = t.spark.read.parquet(path)
    return left.groupBy("day").agg(F.count(F.lit(1)).alias("events")).withColumn("deleted", F.lit(gone))


# ---- messages ------------------------------------------------------------------------------------------------


@query
def json_props(t):
    parsed = t.events.select("event_id", F.from_json("props", "k INT").alias("data"), "props")
    return parsed.select("event_id", "data.k", F.get_json_object("props", "$.k").alias("k_text"))


@query
def json_match(t):
    return _matches(t)


@query
def json_unreadable(t):
    broken = M.unreadable(M.parse(B.match_messages(t), M.MATCH))
    return broken.agg(F.count(F.lit(1)).alias("broken"), F.max(F.length("raw_json")).alias("longest"))


@query
def json_competition(t):
    return M.flatten_competition(M.parse(B.competition_messages(t), M.COMPETITION), audit=False)


def write_message_files(messages: DataFrame, root: str, before: str = '{"competitions": [', after: str = "]}") -> None:
    """``messages`` as files of at most ``FILE_MESSAGES`` each: more messages make more files, not larger ones."""
    # The id counts the rows of a task from a start of its own, so no task and no value can fill a group beyond the limit.
    numbered = messages.withColumn("file", F.floor(F.monotonically_increasing_id() / FILE_MESSAGES))
    whole = numbered.groupBy("file").agg(F.array_join(F.collect_list("value"), ",").alias("all"))
    lines = whole.select(F.concat(F.lit(before), "all", F.lit(after)).alias("value"))
    # One row per file: a file of this kind holds one object.
    lines.write.option("maxRecordsPerFile", 1).text(root)


@query
def competitions_load(t):
    """The competition messages as files of many each, loaded as files."""
    root = scratch(t.spark, "competitions")
    write_message_files(B.competition_messages(t), root)
    return competitions_file(t.spark, root).drop("processed_at")


@query
def standings_dir(t):
    """Standings messages as files, some keys null and some absent, read as a directory and applied in name order."""
    root = scratch(t.spark, "standings")
    write_message_files(B.standings_file_messages(t), root, "[", "]")
    rows = stored(read_standings(t.spark, root, "*.txt"), "rows")
    return load_standings_files(None, rows, SOURCE_FILE).drop("processed_at")


@query
def json_standings(t):
    return M.flatten_standings(M.parse(B.standings_messages(t), M.STANDINGS), audit=False)


def _matches(t: Tables) -> DataFrame:
    return M.flatten_match(M.parse(B.match_messages(t), M.MATCH), audit=False)


@query
def live_match_line(t):
    return views.live_lines(_matches(t))


@query
def home_wins(t):
    return views.home_wins(_matches(t))


@query
def home_matches(t):
    return views.home_matches(_matches(t), "Home 3")


@query
def team_logos(t):
    return views.team_logos(_matches(t))


# ---- upserts ---------------------------------------------------------------------------------------------------


def _event_batches(t: Tables) -> DataFrame:
    """Events in seven batches that are not in time order, newest change per user and batch."""
    rows = t.events.select("user_id", "ts", "event_id", "event_type", (F.col("event_id") % 7).alias("_batch"))
    return U.newest_in_batch(rows, ["user_id", "_batch"], "ts")


@query
def upsert_last_writer(t):
    return U.resolve(_event_batches(t), ["user_id"], ["_batch"])


@query
def upsert_latest_event(t):
    return U.resolve(_event_batches(t), ["user_id"], ["_batch"], U.LATEST_EVENT, "ts")


@query
def upsert_null_key(t):
    """Second batch spells a missing group as '' and must replace the first batch's rows."""
    rows = B.standings(t).select(*views.STANDING_KEY, "position", "points")
    second = rows.where("standing_type <> 'AWAY'").withColumns(
        {"group_name": F.coalesce("group_name", F.lit("")), "points": F.col("points") + 1000}
    )
    return U.upsert(rows, second, views.STANDING_KEY, blank_null=["group_name"])


@query
def upsert_partial(t):
    old = t.orders.where("o_orderstatus <> 'P'")
    new = t.orders.withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("NEW")}
    )
    return U.upsert(old, new, ["o_orderkey"], update_columns=["o_totalprice", "o_orderstatus"])


@query
def standings_from_files(t):
    """Standings messages loaded file by file onto existing rows; only some columns change."""
    flat = stored(M.flatten_standings(M.parse(B.standings_messages(t), M.STANDINGS), audit=False), "standings")
    rows = flat.withColumn("processed_at", F.lit("now"))
    files = rows.withColumn("file", F.concat(F.lit("f"), (F.col("points") % 3).cast("string")))
    state = rows.where("points % 2 = 0").withColumns({"competition_name": F.lit("old"), "won": F.lit(7)})
    state = U.newest_in_batch(state, views.STANDING_KEY, None, ["group_name"])
    return load_standings_files(state, files, "file").drop("processed_at")


def write_lots(t: Tables, make: Callable[[DataFrame], DataFrame], rows: DataFrame, keys: list[str], lots: int, path: str) -> DataFrame:
    """The messages that ``make`` builds from ``rows``, written as files in ``lots`` writes, as a stream of that many micro-batches or more.

    Rows are dealt by ``keys`` before they become text, which is many times as long: more rows make more and larger micro-batches' files, each
    from one share of a shuffle of short rows, never a fixed number of files.
    """
    lot = F.pmod(F.xxhash64(*keys), F.lit(lots))
    for number in range(lots):
        make(rows.where(lot == number).repartition(*keys)).write.mode("append").parquet(path)
    files = len(t.spark.read.schema("value string").parquet(path).inputFiles())
    return t.spark.readStream.schema("value string").option("maxFilesPerTrigger", max(1, files // lots)).parquet(path)


def _event_stream(t: Tables, events: DataFrame, lots: int, path: str) -> DataFrame:
    """Messages of ``events`` as a stream of ``lots`` micro-batches or more."""
    return write_lots(t, lambda rows: B.event_messages(t, rows), events, ["event_id", "user_id"], lots, path)


@query
def stream_upsert(t):
    """Messages written as files, read as a stream in several micro-batches, upserted and compacted."""
    spark = t.spark
    root = scratch(spark, "stream")
    source = _event_stream(t, t.events, 4, f"{root}/in")
    table = MATCHES.table(spark, f"{root}/table", U.LATEST_EVENT)
    run_until_done([start_upserts(source, MATCHES, table, f"{root}/checkpoint", available_now=True, compact_every=2)])
    return table.current().drop("processing_ts")


@query
def stream_restart(t):
    """A run that is lost after a batch is in the log and before its checkpoint; the next run replays the batch."""
    spark = t.spark
    root = scratch(spark, "restart")
    source = _event_stream(t, t.events, 3, f"{root}/in")
    table = MATCHES.table(spark, f"{root}/table", U.LATEST_EVENT)
    record = upsert_batches(MATCHES, table, table.run_for(f"{root}/checkpoint"))

    def lost(batch: DataFrame, batch_id: int) -> None:
        record(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost before the checkpoint")

    writer = source.writeStream.foreachBatch(lost).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    try:
        writer.start().awaitTermination()
    except StreamingQueryException:
        pass
    else:
        raise RuntimeError("the first run should have been lost")
    run_until_done([start_upserts(source, MATCHES, table, f"{root}/checkpoint", available_now=True)])
    return table.current().drop("processing_ts")


def _two_topics(t: Tables) -> dict[str, DataFrame]:
    """Competition and standings messages streamed at the same time into two tables."""
    spark = t.spark
    root = scratch(spark, "topics")
    B.standings_messages(t).write.option("compression", "zstd").option("maxRecordsPerFile", TOPIC_FILE_MESSAGES).parquet(f"{root}/standings-in")
    sources = (
        (COMPETITIONS, write_lots(t, lambda rows: B.competition_messages(t, rows), t.customer, ["c_custkey"], 3, f"{root}/competitions-in")),
        (STANDINGS, spark.readStream.schema("value string").parquet(f"{root}/standings-in")),
    )
    tables, running = {}, []
    for topic, source in sources:
        tables[topic.name] = topic.table(spark, f"{root}/{topic.name}")
        running.append(start_upserts(source, topic, tables[topic.name], f"{root}/checkpoint-{topic.name}", available_now=True, compact_every=2))
    run_until_done(running)
    return {name: table.current().drop("processed_at") for name, table in tables.items()}


@query
def stream_competitions(t):
    return _two_topics(t)["competitions"]


@query
def stream_standings(t):
    return _two_topics(t)["standings"]


@query
def merged_state(t):
    """A batch snapshot and a stream's table as one view, before and after the table is compacted."""
    spark = t.spark
    root = scratch(spark, "merged")
    number = F.col("event_id") % 3
    flat = M.flatten_match(M.parse(B.event_messages(t, t.events.where(number == 0)), M.MATCH))
    snapshot = Snapshot(spark, root, "matches")
    snapshot.refresh(U.newest_in_batch(flat, MATCHES.keys, MATCHES.newest))
    source = _event_stream(t, t.events.where(number > 0), 2, f"{root}/in")
    table = MATCHES.table(spark, f"{root}/table", U.LATEST_EVENT)
    run_until_done([start_upserts(source, MATCHES, table, f"{root}/checkpoint", available_now=True, compact_every=0)])
    before = stored(merged_view(snapshot.read(), table), "merged").withColumn("compacted", F.lit(False))
    table.compact()
    after = merged_view(snapshot.read(), table).withColumn("compacted", F.lit(True))
    return before.unionByName(after).drop("processing_ts")


@query
def event_windows(t):
    """Five-minute counts of events that arrive in four lots, some of them late; every lot is a run of its own from the same checkpoint."""
    spark = t.spark
    root = scratch(spark, "windows")
    lot = F.least(F.floor(F.datediff("ts", F.lit("2024-01-01")) / 10), F.lit(2)) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    lots = stored(t.events.select("event_id", "ts", "event_type", lot.alias("lot")), "lots")
    measures = {"events": F.count(F.lit(1)), "first_event": F.min("event_id")}
    for number in range(4):
        lots.where(F.col("lot") == number).drop("lot").write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema("event_id bigint, ts timestamp, event_type string").parquet(f"{root}/in")
        counted = windowed(source, "ts", "5 minutes", "2 days", ["event_type"], measures)
        run_until_done([start_windows(counted, f"{root}/out", f"{root}/checkpoint", available_now=True)])
    return spark.read.parquet(f"{root}/out")


# ---- layers, quality, pipeline --------------------------------------------------------------------------------------


def write_raw(t: Tables, root: str, names) -> None:
    """Raw tables as CSV below ``root``, one folder per table. Up to four are submitted together, as in the stages of the pipeline."""

    def one(name: str) -> None:
        B.RAW[name](t).write.option("header", True).option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}/{name}.csv")

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(inheritable_thread_target(t.spark)(one), names))


@query
def ingest_roundtrip(t):
    """Tables to CSV, CSV to bronze Parquet with lineage, and back."""
    root = scratch(t.spark, "ingest")
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit('say "hi",\n'), F.col("o_orderpriority")))
        .when(F.col("o_orderkey") % 7 == 0, F.lit(None))
        .otherwise(F.col("o_orderpriority"))
        .alias("note"),
        "o_totalprice",
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/raw/orders/orders.csv")
    raise_failures("bronze", ingest(t.spark, f"{root}/raw", f"{root}/bronze", ["orders"]))
    bronze = read_layer(t.spark, f"{root}/bronze", "orders")
    assert verify_layer(t.spark, f"{root}/bronze", ["orders"])[0]["columns"] == 5
    named = F.col("bronze_source_file").contains("orders.csv") & F.col("bronze_ingestion_timestamp").isNotNull()
    return bronze.select(
        F.col("o_orderkey").cast("bigint"), "note", F.col("o_totalprice").cast("double"), named.alias("has_lineage")
    )


@query
def dq_findings(t):
    return checks.check_sources({name: build(t) for name, build in B.RAW.items()}, B.AS_OF)


@query
def layer_profile(t):
    """Missing shares, families and number ranges of every column of all raw tables."""
    return Q.layer_profile({name: build(t) for name, build in B.RAW.items()}, checks.SOURCE_FAMILIES)


@query
def quality_report(t):
    """Two recorded checks of raw tables and stored snapshots, and what became of every rule between them.

    By the second run transfers within a team and wrongly dated injuries are gone, valuations have come, profiles are not checked any more
    and the snapshot of teams has lost the teams without a division.
    """
    root = scratch(t.spark, "quality")
    log = FindingsLog(t.spark, f"{root}/log")
    deals, stays, teams = (B.RAW[n](t) for n in ("transfer_history", "player_injuries", "team_details"))
    clean = E.lenient_date("end_date") >= E.lenient_date("from_date")
    states = (
        {"transfer_history": deals, "player_injuries": stays, "player_profiles": B.raw_profiles(t)},
        {
            "transfer_history": deals.where("from_team_id <> to_team_id"),
            "player_injuries": stays.where(F.coalesce(clean, F.lit(True))),
            "player_market_value": B.raw_values(t),
        },
    )
    for raw, shown in zip(states, (teams, teams.where("club_division IS NOT NULL"))):
        Snapshot(t.spark, f"{root}/snapshots", "teams").refresh(shown)
        found = [checks.check_sources(raw, B.AS_OF), checks.check_snapshots(t.spark, f"{root}/snapshots", ["teams", "never_stored"])]
        log.record(Q.combine(found))
    return log.changes()


@query
def constraint_checks(t):
    serving = {
        "matches": stored(_matches(t), "matches"),
        "live_events": stored(B.live_events(t), "live_events"),
        "competitions": _competitions(t),
        "leaderboards": _leaderboards(t),
    }
    return checks.check_constraints(B.gold(t) | serving)


@query
def range_checks(t):
    parts = B.gold(t)
    shown = {"vw_high_value_low_risk_players": views.high_value_low_risk(parts["player_analytics_360"])}
    silver = {n: B.silver(t, n) for n in ("player_profiles", "player_performances")}
    sizes = {"injury_risk_scores": (30_000, 35_000), "transfer_intelligence": (1, 10**12)}
    return checks.validate(parts, silver, shown, sizes)


@query
def quality_verdict(t):
    return Q.verdict(constraint_checks(t))


@query
def load_report(t):
    """What a load of all tables reports: every one with its rows, whatever its size."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    target = JdbcTarget("jdbc:none")
    report = load_tables({n: getattr(t, n) for n in names}, target, None, write=lambda df, *_: df.write.format("noop").mode("overwrite").save())
    return t.spark.createDataFrame([(r["table"], r["rows"], r["status"]) for r in report], "table_name string, row_count bigint, status string")


@query
def pipeline_run(t):
    """CSV files of all raw tables through every stage; the combined profile at the end."""
    root = scratch(t.spark, "pipeline")
    write_raw(t, f"{root}/raw", B.RAW)
    run_pipeline(t.spark, f"{root}/raw", f"{root}/out", B.AS_OF)
    return read_layer(t.spark, f"{root}/out/gold", "player_analytics_360").drop("gold_processed_timestamp")
