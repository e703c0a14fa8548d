"""The driver's tables in the shapes the library works on.

Each function is a projection (or one aggregation) of whole tables; nothing is made up or cut off.
The same mappings are written in SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.operators.ranking import partition_rank
from statforge.plans import metrics
from statforge.plans.silver import clean_table
from statforge.session import stored

# Fixed value: the day ages are computed on.
AS_OF = "2024-06-30"


class Tables:
    """Lazy access to the Parquet tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# ---- raw shapes: text columns with the dirt the cleaning rules deal with ----------------------------


def raw_profiles(t: Tables) -> DataFrame:
    """Customers as raw profiles. Every eighth row is there twice with another slug."""
    key = F.col("c_custkey")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    born = F.date_add(F.lit("1985-01-01").cast("date"), (key * 37 % 7000).cast("int"))
    height = (
        F.when(key % 3 == 0, "0")
        .when(key % 3 == 1, F.concat(F.lit("1."), (F.lit(50) + key % 50).cast("string")))
        .otherwise((F.lit(150) + key % 60).cast("string"))
    )
    copies = F.when(key % 8 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    return rows.select("*", F.explode(copies).alias("copy")).select(
        key.alias("player_id"),
        F.when(key % 194 == 5, F.lit(None))
        .otherwise(F.concat(F.lit(" slug-"), key.cast("string"), F.lit("-"), F.col("copy"), F.lit(" ")))
        .alias("player_slug"),
        F.when(key % 97 == 5, F.lit(None)).otherwise(F.concat(F.lit("  "), F.col("c_name"))).alias("player_name"),
        F.lit(None).cast("string").alias("player_image_url"),
        F.when(key % 50 == 0, F.lit("2020-13-01")).otherwise(born.cast("string")).alias("date_of_birth"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.concat(F.col("n_name"), F.lit(" "))).alias("place_of_birth"),
        F.when(key % 9 == 0, F.lit("  ")).otherwise(F.col("n_name")).alias("country_of_birth"),
        height.alias("height"),
        F.col("n_name").alias("citizenship"),
        F.when(key % 41 == 0, F.lit(None)).otherwise(F.initcap("c_mktsegment")).alias("position"),
        F.when(key % 5 == 0, F.lit(None)).when(key % 2 == 0, F.lit(" left")).otherwise(F.lit("Right ")).alias("foot"),
        F.col("c_nationkey").cast("string").alias("current_club_id"),
        F.lit("2020-07-01").alias("joined"),
        F.when(key % 4 == 0, F.lit("x")).otherwise(F.lit("2026-06-30")).alias("contract_expires"),
        F.lit(None).cast("string").alias("social_media_url"),
        F.col("c_mktsegment").alias("main_position"),
    )


def raw_performances(t: Tables) -> DataFrame:
    """Order lines as season rows with text numbers, some of them unreadable."""
    line = F.col("l_linenumber")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    goals = F.when(line == 7, F.lit("n/a")).when(line == 1, F.lit("1")).otherwise(F.lit("0"))
    minutes = F.col("l_quantity").cast("int") * (F.lit(1) + F.col("o_custkey") % 4)
    zero = F.lit(None).cast("string")
    return rows.select(
        F.when(F.col("l_partkey") % 501 == 500, F.lit(None)).otherwise(F.col("o_custkey")).alias("player_id"),
        F.concat(F.lit(" "), F.year("o_orderdate").cast("string")).alias("season_name"),
        F.col("o_orderpriority").alias("competition_id"),
        F.concat(F.col("o_orderpriority"), F.lit("  ")).alias("competition_name"),
        F.col("l_suppkey").cast("string").alias("team_id"),
        F.lit("").alias("team_name"),
        F.lit("1").alias("nb_in_group"),
        F.when(line == 6, F.lit(None)).otherwise(F.lit("1.0")).alias("nb_on_pitch"),
        goals.alias("goals"),
        zero.alias("own_goals"),
        _flag(F.col("l_discount") >= 0.08).cast("string").alias("assists"),
        zero.alias("subed_in"),
        zero.alias("subed_out"),
        _flag(F.col("l_returnflag") == "A").cast("string").alias("yellow_cards"),
        _flag((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).cast("string").alias("second_yellow_cards"),
        _flag((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")).cast("string").alias("direct_red_cards"),
        _flag((line == 1) & (F.col("l_tax") > 0.05)).cast("string").alias("penalty_goals"),
        F.concat(minutes.cast("string"), F.lit(".5")).alias("minutes_played"),
        F.when(line == 3, F.lit("3000000000")).otherwise(F.lit("4")).alias("goals_conceded"),
        F.lit(" 2 ").alias("clean_sheets"),
    )


def order_value() -> Column:
    return F.floor(F.col("o_totalprice") * 25 * (F.col("o_custkey") % 10 + 1))


def raw_values(t: Tables) -> DataFrame:
    """Orders as valuations, with values as text; days repeat per customer."""
    return t.orders.select(
        F.col("o_custkey").alias("player_id"),
        F.col("o_orderdate").cast("date").alias("date_unix"),
        order_value().cast("string").alias("value"),
    )


def raw_injuries(t: Tables) -> DataFrame:
    """Error events as injuries; the stay ends before it starts for some."""
    user = F.col("user_id")
    day = F.col("ts").cast("date")
    return t.events.where(F.col("event_type") == "error").select(
        user.alias("player_id"),
        F.concat(F.lit("23/24 ")).alias("season_name"),
        F.concat(F.lit(" "), F.get_json_object("props", "$.k")).alias("injury_reason"),
        day.cast("string").alias("from_date"),
        F.when(F.col("event_id") % 10 == 0, F.lit("unknown"))
        .otherwise(F.date_add(day, (F.col("event_id") % 30 - 2).cast("int")).cast("string"))
        .alias("end_date"),
        F.floor(F.col("value") * (1 + user % 6)).cast("string").alias("days_missed"),
        F.when(F.col("event_id") % 13 == 0, F.lit("-")).otherwise(F.floor(F.col("value") / 7).cast("string")).alias("games_missed"),
    )


def raw_transfers(t: Tables) -> DataFrame:
    """Orders as transfers: fees are numbers, words or missing."""
    fee = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .when(F.col("o_orderstatus") == "P", F.lit(" free transfer"))
    )
    return t.orders.select(
        F.col("o_custkey").alias("player_id"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit(" ")).alias("season_name"),
        F.col("o_orderdate").cast("date").cast("string").alias("transfer_date"),
        (F.col("o_orderkey") % 20).cast("string").alias("from_team_id"),
        F.lit(" A").alias("from_team_name"),
        (F.col("o_custkey") % 20).cast("string").alias("to_team_id"),
        F.lit("B ").alias("to_team_name"),
        F.floor(F.col("o_totalprice") * 1.2).cast("string").alias("value_at_transfer"),
        fee.alias("transfer_fee"),
    )


def raw_teams(t: Tables) -> DataFrame:
    """Suppliers as clubs; some keys exist both bare and with a leading blank."""
    key = F.col("s_suppkey")
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    copies = F.when(key % 5 == 0, F.array(F.lit(""), F.lit(" "))).otherwise(F.array(F.lit("")))
    return rows.select("*", F.explode(copies).alias("pad")).select(
        F.concat(F.col("pad"), key.cast("string")).alias("club_id"),
        F.concat(F.lit("club-"), key.cast("string"), F.lit(" ")).alias("club_slug"),
        F.concat(F.lit(" "), F.col("s_name")).alias("club_name"),
        F.lit(None).cast("string").alias("logo_url"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("country_name"),
        F.lit("2024").alias("season_id"),
        F.col("n_regionkey").cast("string").alias("competition_id"),
        F.lit(" slug").alias("competition_slug"),
        F.lit("name ").alias("competition_name"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.lit(" First")).alias("club_division"),
        F.lit("src").alias("source_url"),
    )


def raw_national(t: Tables) -> DataFrame:
    """Orders as national-team rows."""
    return t.orders.select(
        F.when(F.col("o_orderkey") % 100 == 3, F.lit(None)).otherwise(F.col("o_custkey")).alias("player_id"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("team_id"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("03/05/2001")).otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("debut"),
        (F.col("o_orderkey") % 90).cast("string").alias("matches"),
        F.when(F.col("o_orderkey") % 6 == 0, F.lit("none")).otherwise((F.col("o_orderkey") % 30).cast("string")).alias("goals"),
    )


def raw_teammates(t: Tables) -> DataFrame:
    """Order lines as teammate rows: customer and supplier that met in an order."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("o_custkey").alias("player_id"),
        F.when(F.col("l_suppkey") % 50 == 7, F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))).alias("teammate_player_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("teammate_player_name"),
        F.when(F.col("l_linenumber") == 2, F.lit("?")).otherwise(F.col("l_tax").cast("decimal(10,2)").cast("string")).alias("ppg_played_with"),
        F.col("l_linenumber").cast("string").alias("joint_goal_participation"),
        F.col("l_quantity").cast("decimal(10,1)").cast("string").alias("minutes_played_with"),
    )


def raw_team_seasons(t: Tables) -> DataFrame:
    """Standings totals as raw club seasons with an extra column that must pass through."""
    s = standings(t).where("standing_type = 'TOTAL'")
    return s.select(
        F.concat(F.lit(" "), F.col("team_id").cast("string")).alias("club_id"),
        F.col("competition_id").cast("string").alias("competition_id"),
        F.concat(F.col("competition_name"), F.lit(" ")).alias("competition_name"),
        F.concat(F.lit(" "), F.col("team_name")).alias("team_name"),
        F.concat(F.col("season_id").cast("string"), F.lit(" ")).alias("season_season"),
        F.col("position").cast("string").alias("season_rank"),
        F.concat(F.col("draw").cast("string"), F.lit(".0")).alias("season_draws"),
        F.col("won").cast("string").alias("season_wins"),
        F.lit("-").alias("season_losses"),
        F.col("points").cast("string").alias("season_points"),
        F.col("goals_for").cast("string").alias("season_goals_for"),
        F.col("goals_against").cast("string").alias("season_goals_against"),
        F.col("goal_difference").cast("string").alias("season_goal_difference"),
        F.concat(F.lit(" "), F.col("form")).alias("extra_form"),
    )


def raw_team_children(t: Tables) -> DataFrame:
    """Suppliers below their nation as child teams."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.when(F.col("s_suppkey") % 10 == 9, F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("n_nationkey").cast("string"))).alias("parent_team_id"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("parent_team_name"),
        F.concat(F.lit("c"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("child_team_id"),
        F.concat(F.lit(" "), F.col("s_name")).alias("child_team_name"),
    )


RAW = {
    "player_profiles": raw_profiles,
    "player_performances": raw_performances,
    "player_market_value": raw_values,
    "player_injuries": raw_injuries,
    "player_national_performances": raw_national,
    "player_teammates_played_with": raw_teammates,
    "transfer_history": raw_transfers,
    "team_details": raw_teams,
    "team_competitions_seasons": raw_team_seasons,
    "team_children": raw_team_children,
}


def silver(t: Tables, name: str) -> DataFrame:
    """Cleaned table over the driver's data, without audit columns."""
    return clean_table(name, RAW[name](t), audit=False)


METRICS = {
    "player_form_metrics": (metrics.form_metrics, "player_performances"),
    "market_value_trends": (metrics.value_summary, "player_market_value"),
    "injury_risk_scores": (metrics.injury_risk, "player_injuries"),
    "transfer_intelligence": (metrics.transfer_intelligence, "transfer_history"),
}


def metric(t: Tables, name: str) -> DataFrame:
    """One metric table over the driver's data, without audit columns."""
    compute, source = METRICS[name]
    return compute(silver(t, source), audit=False)


def profile_360(t: Tables) -> DataFrame:
    parts = (metric(t, name) for name in METRICS)
    return metrics.profile_360(silver(t, "player_profiles"), *parts, as_of=AS_OF, audit=False)


def scored_profile(t: Tables) -> DataFrame:
    """The profile without its ranks, for views that use none: nothing is sorted or stored for them."""
    parts = (metric(t, name) for name in METRICS)
    return metrics.scored_profile(silver(t, "player_profiles"), *parts, as_of=AS_OF)


def gold(t: Tables) -> dict[str, DataFrame]:
    """All metric tables, each stored, as the serving views find them."""
    parts = {name: stored(metric(t, name), name) for name in METRICS}
    profile = metrics.profile_360(silver(t, "player_profiles"), *parts.values(), as_of=AS_OF, audit=False)
    return {**parts, "player_analytics_360": stored(profile, "player_analytics_360")}


# ---- standings, competitions ------------------------------------------------------------------------


def standings(t: Tables) -> DataFrame:
    """Orders as league results: region = competition, year = season, nation = team.

    Orders are first summed per customer's nation, year and venue, so only those sums are joined to
    the dimensions, ranked and doubled into totals.
    """
    home = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    games = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("team_id"),
        F.year("o_orderdate").alias("season_id"),
        F.when(home, "HOME").otherwise("AWAY").alias("venue"),
    )
    measured = games.agg(
        F.count(F.lit(1)).alias("played_games"),
        F.count_if(F.col("o_orderstatus") == "F").alias("won"),
        F.count_if(F.col("o_orderstatus") == "P").alias("draw"),
        F.count_if(F.col("o_orderstatus") == "O").alias("lost"),
        F.sum(F.col("o_orderkey") % 4).alias("goals_for"),
        F.sum(F.col("o_custkey") % 4).alias("goals_against"),
    )
    both = measured.select("*", F.explode(F.array("venue", F.lit("TOTAL"))).alias("standing_type"))
    sums = both.groupBy("team_id", "season_id", "standing_type").agg(
        *(F.sum(c).cast("int").alias(c) for c in ("played_games", "won", "draw", "lost", "goals_for", "goals_against"))
    )
    named = sums.join(t.nation, F.col("team_id") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = named.select(
        F.col("r_regionkey").alias("competition_id"),
        F.col("r_name").alias("competition_name"),
        F.substring("r_name", 1, 2).alias("competition_code"),
        F.lit("LEAGUE").alias("competition_type"),
        "season_id",
        F.lit("REGULAR_SEASON").alias("stage"),
        "standing_type",
        F.when(F.col("team_id") % 2 == 0, "Group A").alias("group_name"),
        "team_id",
        F.col("n_name").alias("team_name"),
        F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("team_tla"),
        F.concat(F.lit("https://crest/"), F.col("team_id").cast("string")).alias("team_crest_url"),
        "played_games",
        "won",
        "draw",
        "lost",
        (F.col("won") * 3 + F.col("draw")).alias("points"),
        "goals_for",
        "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        F.concat_ws("", F.when(F.col("won") > F.col("lost"), "W").otherwise("L"), F.when(F.col("draw") % 2 == 0, "D")).alias("form"),
    )
    return partition_rank(
        rows, ["competition_id", "season_id", "standing_type"], ["points", "goal_difference", "goals_for"], "position"
    )


def competitions(t: Tables) -> DataFrame:
    """One competition per region; the last one's current season has no results yet."""
    per_nation = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.max(F.year("o_orderdate")).alias("last"))
    )
    per_region = (
        per_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey")
        .agg(F.max("last").alias("last"))
    )
    rows = t.region.join(per_region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    season = F.col("last") + _flag(F.col("r_regionkey") == 4)
    return rows.select(
        F.col("r_regionkey").alias("competition_id"),
        F.col("r_name").alias("competition_name"),
        F.substring("r_name", 1, 2).alias("competition_code"),
        F.lit("LEAGUE").alias("competition_type"),
        F.concat(F.lit("area "), F.col("r_name")).alias("area_name"),
        season.alias("current_season_id"),
        (F.col("r_regionkey") + 30).alias("current_matchday"),
        F.make_date(season, F.lit(1), F.lit(1)).alias("season_start_date"),
        F.make_date(season, F.lit(12), F.lit(31)).alias("season_end_date"),
    )


# ---- live events -------------------------------------------------------------------------------------


def live_events(t: Tables) -> DataFrame:
    """Events as match events: the user is the match, value and props are the score."""
    match = F.col("user_id")
    home = F.floor(F.col("value")) % 5
    away = F.get_json_object("props", "$.k").cast("int") % 5
    return t.events.select(
        match.alias("match_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("event_type").alias("status"),
        (F.col("event_id") % 90).cast("int").alias("minute"),
        F.concat(F.lit("League "), (match % 8).cast("string")).alias("competition_name"),
        F.concat(F.lit("L"), (match % 8).cast("string")).alias("competition_code"),
        F.concat(F.lit("H"), (match % 20).cast("string")).alias("home_team_name"),
        F.when(match % 29 == 0, F.lit(None)).otherwise(F.concat(F.lit("A"), (match % 17).cast("string"))).alias("away_team_name"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(home).cast("int").alias("home_score"),
        away.cast("int").alias("away_score"),
        (home + away).cast("int").alias("total_goals"),
        F.when(home > away, "HOME").when(home < away, "AWAY").otherwise("DRAW").alias("match_result"),
        F.concat(F.lit("V"), (match % 5).cast("string")).alias("venue"),
        (F.col("event_type") != "signup").alias("is_live"),
    )


# ---- messages ------------------------------------------------------------------------------------------


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows spread by their key, as messages are over the partitions of a topic: a table of one small file would be one task.

    The number of tasks is the session's and given outright: tasks merged by the size of these short rows would be few, not many more than
    cores, and some cores would wait while the text that the rows become is built and parsed.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def match_messages(t: Tables) -> DataFrame:
    """Orders as match messages (JSON text); every 50th is broken."""
    key = F.col("o_orderkey")
    number = key.cast("int")
    kickoff = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.struct(
        key.alias("id"),
        kickoff.alias("utcDate"),
        F.when(key % 31 == 0, F.lit(None)).otherwise(F.element_at(F.create_map(F.lit("F"), F.lit("FINISHED"), F.lit("O"), F.lit("IN_PLAY"), F.lit("P"), F.lit("SCHEDULED")), F.col("o_orderstatus"))).alias("status"),
        F.when(key % 3 == 0, number % 38).alias("matchday"),
        F.when(key % 4 == 0, "REGULAR_SEASON").alias("stage"),
        F.lit("2024-01-02T03:04:05Z").alias("lastUpdated"),
        F.struct((number % 5).alias("id"), F.lit("Area").alias("name")).alias("area"),
        F.struct((number % 7).alias("id"), F.concat(F.lit("Cup "), (key % 7).cast("string")).alias("name")).alias("competition"),
        F.struct(
            F.year("o_orderdate").alias("id"),
            F.date_format("o_orderdate", "yyyy-01-01").alias("startDate"),
            F.lit("bad").alias("endDate"),
            F.struct(F.lit(3).alias("id")).alias("winner"),
        ).alias("season"),
        F.struct((number % 20).alias("id"), F.concat(F.lit("Home "), (key % 20).cast("string")).alias("name"), F.concat(F.lit("c/"), (key % 20).cast("string")).alias("crest")).alias("homeTeam"),
        F.struct(F.col("o_custkey").alias("id"), F.concat(F.lit("Away "), F.col("o_custkey").cast("string")).alias("name")).alias("awayTeam"),
        F.struct(
            F.when(F.col("o_orderstatus") == "F", F.when(key % 2 == 0, "HOME_TEAM").otherwise("AWAY_TEAM")).alias("winner"),
            F.struct(F.when(key % 6 != 0, number % 6).alias("home"), (number % 4).alias("away")).alias("fullTime"),
        ).alias("score"),
    )
    text = F.to_json(body)
    return _dealt(t.orders, "o_orderkey").select(F.when(key % 50 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def competition_messages(t: Tables, customers: DataFrame | None = None) -> DataFrame:
    """Customers (all of them, if none are given) as competition messages: many small objects with optional parts."""
    key = F.col("c_custkey").cast("int")
    season = F.struct(
        key.alias("id"),
        F.lit("2023-08-01").alias("startDate"),
        F.when(key % 2 == 0, "2024-05-31").alias("endDate"),
        F.when(key % 3 == 0, key % 38).alias("currentMatchday"),
        F.when(key % 4 == 0, F.struct((key + 1).alias("id"), F.lit("Winner").alias("name"))).alias("winner"),
    )
    body = F.struct(
        key.alias("id"),
        F.when(key % 11 != 0, F.col("c_name")).alias("name"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("code"),
        F.lit("LEAGUE").alias("type"),
        F.struct(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name")).alias("area"),
        F.when(key % 5 != 0, season).alias("currentSeason"),
        F.when(key % 7 == 0, key % 50).alias("numberOfAvailableSeasons"),
        F.lit("2024-01-02T03:04:05Z").alias("lastUpdated"),
    )
    return (t.customer if customers is None else customers).select(F.to_json(body).alias("value"))


def standings_messages(t: Tables) -> DataFrame:
    """Order lines as standings messages: a table of two teams, one without rows and one missing."""
    key = F.col("l_orderkey").cast("int")

    def team(position: int, number: Column, points: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.struct(
                F.when(number % 10 != 0, number).alias("id"),
                F.concat(F.lit("S"), number.cast("string")).alias("name"),
            ).alias("team"),
            F.when(F.col("l_partkey") % 3 == 0, F.col("l_linenumber")).alias("playedGames"),
            points.alias("points"),
            F.lit("WDL").alias("form"),
        )

    supplier, part = F.col("l_suppkey").cast("int"), F.col("l_partkey").cast("int")
    quantity = F.col("l_quantity").cast("int")
    teams = F.array(team(1, supplier, quantity), team(2, part, quantity - 1))

    def standing(kind: Column, table: Column) -> Column:
        return F.struct(kind.alias("type"), F.col("l_returnflag").alias("group"), table.alias("table"))

    flagged = F.when(F.col("l_returnflag") == "R", "TOTAL")
    tables = F.array(
        standing(flagged, teams),
        standing(F.lit("HOME"), F.when(F.col("l_linestatus") == "F", F.slice(teams, 1, 1))),
        standing(F.lit("AWAY"), F.slice(teams, 1, 0)),
    )
    body = F.struct(
        F.struct((key % 5).alias("id"), F.lit("Area").alias("name")).alias("area"),
        F.struct(key.alias("id"), F.concat(F.lit("League "), key.cast("string")).alias("name"), F.lit("L").alias("code")).alias("competition"),
        F.struct(F.when(key % 9 != 0, F.lit(2024)).alias("id"), F.lit("2024-01-01").alias("startDate")).alias("season"),
        F.when(key % 13 != 0, tables).alias("standings"),
    )
    return _dealt(t.lineitem, "l_orderkey", "l_linenumber").select(F.to_json(body).alias("value"))


def standings_file_messages(t: Tables) -> DataFrame:
    """Suppliers as standings messages of two teams; messages of even keys spell missing values as null, the others leave them out."""
    key = F.col("s_suppkey").cast("int")

    def team(position: int) -> Column:
        number = key * 2 + position
        return F.struct(
            F.lit(position).alias("position"),
            F.struct(F.when(number % 7 != 0, number).alias("id"), F.concat(F.lit("T"), number.cast("string")).alias("name"), F.lit(None).cast("string").alias("tla")).alias("team"),
            F.when(key % 3 == 0, key % 30).alias("playedGames"),
            F.when(key % 4 == 0, key % 20).alias("won"),
            (key % 50 + position).alias("points"),
            F.when(key % 5 == 0, F.lit("WDL")).alias("form"),
        )

    table = F.struct(
        F.when(key % 11 != 0, "REGULAR_SEASON").alias("stage"), F.when(key % 9 != 0, "TOTAL").alias("type"), F.when(key % 2 == 0, "G").alias("group"), F.array(team(1), team(2)).alias("table")
    )
    body = F.struct(
        F.struct(F.col("s_nationkey").cast("int").alias("id"), F.lit("Area").alias("name")).alias("area"),
        F.struct(key.alias("id"), F.col("s_name").alias("name")).alias("competition"),
        F.struct(F.lit(2024).alias("id"), F.lit("2024-01-01").alias("startDate"), F.when(key % 6 == 0, key % 38).alias("currentMatchday")).alias("season"),
        F.array(table).alias("standings"),
    )
    return t.supplier.select(F.when(key % 2 == 0, F.to_json(body, {"ignoreNullFields": "false"})).otherwise(F.to_json(body)).alias("value"))


def event_messages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Events (all of them, if none are given) as match messages that update one match per user; later events carry later times."""
    user = F.col("user_id")
    updated = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id"))
    body = F.struct(
        user.alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utcDate"),
        F.upper("event_type").alias("status"),
        F.date_format(updated, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdated"),
        F.struct((user % 20).alias("id"), F.concat(F.lit("H"), (user % 20).cast("string")).alias("name")).alias("homeTeam"),
        F.struct(
            F.struct((F.floor("value") % 5).alias("home"), F.lit(1).alias("away")).alias("fullTime"),
        ).alias("score"),
    )
    return (t.events if events is None else events).select(F.to_json(body).alias("value"))


def raw_latest_values(t: Tables) -> DataFrame:
    """Newest order value per customer as the latest-valuation table (ingested, not used further)."""
    newest = t.orders.groupBy(F.col("o_custkey").alias("player_id")).agg(
        F.max_by(order_value(), "o_orderkey").cast("string").alias("latest_market_value"),
        F.max(F.col("o_orderdate").cast("date")).alias("value_date"),
    )
    return newest


RAW["player_latest_market_value"] = raw_latest_values
