"""Serving queries over the profile, standings, live-event and match tables.

Plain functions from DataFrames to DataFrames. Every ordering is total (a key is appended where the
sort columns can tie) and states where NULLs go.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.functions import expr as E
from statforge.operators.dedup import latest_by_key
from statforge.operators.ranking import partition_rank


def _down(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def _up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


# ---- players ----------------------------------------------------------------------------------


def top_players(profile: DataFrame, limit: int = 100) -> DataFrame:
    """Best players by overall score."""
    shown = [
        "player_id", "player_name", "age", "player_main_position", "overall_player_score",
        "performance_score", "market_score", "health_score", "player_rank", "peak_market_value",
        "latest_market_value", "latest_valuation_timestamp", "total_goals", "total_assists",
        "injury_risk_level",
    ]
    scored = profile.where("overall_player_score > 0").select(*shown)
    return scored.orderBy(*_down("overall_player_score"), *_up("player_id")).limit(limit)


def high_value_low_risk(profile: DataFrame) -> DataFrame:
    """Players aged 20-30 worth over 10M at their peak whose injury risk is known to be low."""
    shown = [
        "player_id", "player_name", "age", "player_main_position", "peak_market_value", "latest_market_value",
        "latest_valuation_timestamp", "avg_market_value", "injury_risk_level", "total_injuries",
        "total_goals", "total_assists", "overall_player_score",
    ]
    wanted = (
        (F.col("peak_market_value") > 10_000_000)
        & (F.col("injury_risk_level") == "LOW")
        & F.col("age").between(20, 30)
    )
    return profile.where(wanted).select(*shown).orderBy(*_down("peak_market_value"), *_up("player_id"))


def opportunity_score() -> Column:
    """Points for score, profit, low risk and a good age, held within 0-100; 0 without a value."""
    age = F.col("age")
    parts = [
        F.col("overall_player_score") * 0.4,
        F.when(F.col("transfer_value_trend") == "PROFIT", 20.0).otherwise(0.0),
        F.when(F.col("injury_risk_level") == "LOW", 20.0)
        .when(F.col("injury_risk_level") == "MEDIUM", 10.0)
        .otherwise(0.0),
        F.when(age.between(22, 26), 20.0).when(age.between(20, 28), 15.0).otherwise(5.0),
    ]
    points = reduce(Column.__add__, parts)
    return F.when(F.col("latest_market_value") > 0, E.clamp(points, 0.0, 100.0)).otherwise(0.0)


def transfer_opportunities(profile: DataFrame, transfers: DataFrame) -> DataFrame:
    """Young, valued, low-risk players whose transfers made a profit."""
    market = transfers.where("transfer_value_trend = 'PROFIT'").select(
        "player_id",
        "transfer_value_trend",
        F.col("total_transfers").alias("transfers"),
        F.col("avg_transfer_fee").alias("mean_fee"),
    )
    candidates = profile.where(
        F.col("age").between(20, 28)
        & F.col("injury_risk_level").isin("LOW", "MEDIUM")
        & (F.col("overall_player_score") > 50)
        & (F.col("latest_market_value") > 0)
    ).join(market, "player_id")
    return candidates.select(
        "player_id",
        "player_name",
        "age",
        "player_main_position",
        "peak_market_value",
        "latest_market_value",
        "latest_valuation_timestamp",
        "avg_market_value",
        (F.col("latest_market_value") - F.col("avg_market_value")).alias("value_growth"),
        "total_goals",
        "goals_per_90min",
        F.col("transfers").alias("total_transfers"),
        F.col("mean_fee").alias("avg_transfer_fee"),
        "transfer_value_trend",
        "injury_risk_level",
        "overall_player_score",
        opportunity_score().alias("opportunity_score"),
    ).orderBy(*_down("opportunity_score", "overall_player_score"), *_up("player_id"))


def _averages(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> list[Column]:
    """Averages that do not depend on row order: doubles are summed as decimals."""
    kinds = dict(df.dtypes)
    return [
        (F.avg(E.money(source)).cast("double") if kinds[source] == "double" else F.avg(source)).alias(name)
        for name, source in pairs
    ]


# The averages both player summaries report.
_COMMON_AVERAGES = (
    ("avg_overall_score", "overall_player_score"),
    ("avg_peak_market_value", "peak_market_value"),
    ("avg_latest_market_value", "latest_market_value"),
    ("avg_market_value", "avg_market_value"),
    ("avg_goals", "total_goals"),
    ("avg_assists", "total_assists"),
)


def position_statistics(profile: DataFrame) -> DataFrame:
    """Averages and risk counts per position."""
    rates = (("avg_goals_per_90min", "goals_per_90min"), ("avg_assists_per_90min", "assists_per_90min"), ("avg_age", "age"))
    risks = [
        F.count_if(F.col("injury_risk_level") == level).alias(f"{level.lower()}_risk_count")
        for level in ("HIGH", "MEDIUM", "LOW")
    ]
    known = profile.where(F.col("player_main_position").isNotNull())
    return known.groupBy("player_main_position").agg(
        F.count(F.lit(1)).alias("total_players"), *_averages(known, _COMMON_AVERAGES), *_averages(known, rates), *risks
    )


def age_group(column: str = "age") -> Column:
    bounds = ((20, "U21"), (25, "21-25"), (30, "26-30"), (35, "31-35"))
    return E.label_by_ceiling(column, bounds, above="35+", missing="Unknown")


def age_group_analysis(profile: DataFrame) -> DataFrame:
    """Averages per age bucket, for players of known age."""
    extra = (("avg_injury_score", "injury_severity_score"), ("avg_transfers", "total_transfers"))
    aged = profile.where(F.col("age").isNotNull()).withColumn("age_group", age_group())
    return aged.groupBy("age_group").agg(
        F.count(F.lit(1)).alias("total_players"), *_averages(aged, _COMMON_AVERAGES), *_averages(aged, extra)
    )


def reliable_scorers(
    profile: DataFrame, form: DataFrame, injuries: DataFrame, values: DataFrame, goals: int = 50, limit: int = 20
) -> DataFrame:
    """Most efficient scorers above a number of goals with low injury risk."""
    scorers = form.where(F.col("total_goals") > goals).select("player_id", "total_goals", "goals_per_90min")
    safe = injuries.where("injury_risk_level = 'LOW'").select("player_id", "injury_risk_level")
    peaks = values.select("player_id", "peak_market_value")
    people = profile.select("player_id", "player_name", "age", "player_main_position")
    joined = people.join(scorers, "player_id").join(safe, "player_id").join(peaks, "player_id")
    best = joined.orderBy(*_down("goals_per_90min"), *_up("player_id")).limit(limit)
    return best.select(
        "player_id",
        "player_name",
        "age",
        "player_main_position",
        "total_goals",
        "goals_per_90min",
        "injury_risk_level",
        "peak_market_value",
    )


def young_opportunities(opportunities: DataFrame, below_age: int = 25, limit: int = 20) -> DataFrame:
    young = opportunities.where(F.col("age") < below_age)
    return young.orderBy(*_down("overall_player_score"), *_up("player_id")).limit(limit)


def positions_by_score(stats: DataFrame) -> DataFrame:
    return stats.orderBy(*_down("avg_overall_score"), *_up("player_main_position"))


def positions_by_size(stats: DataFrame) -> DataFrame:
    return stats.orderBy(*_down("total_players"), *_up("player_main_position"))


def valuable_safe_players(safe: DataFrame, above: int = 10_000_000, limit: int = 20) -> DataFrame:
    rich = safe.where(F.col("latest_market_value") > above)
    return rich.orderBy(*_down("overall_player_score"), *_up("player_id")).limit(limit)


# ---- standings --------------------------------------------------------------------------------

# The key under which a standings row is unique.
STANDING_KEY = ("competition_id", "season_id", "stage", "standing_type", "team_id", "group_name")


def _current_totals(standings: DataFrame, competitions: DataFrame, extra: Sequence[str]) -> DataFrame:
    """TOTAL rows of each competition's current season with some columns of the competition.

    The competition table is the small side; Spark broadcasts it when its measured size allows.
    """
    dimension = competitions.select(
        F.col("competition_id").alias("__cid"),
        F.col("current_season_id").alias("__sid"),
        *(F.col(c).alias(f"__c_{c}") for c in extra),
    )
    totals = standings.where("standing_type = 'TOTAL'").drop(*extra)
    on = (F.col("competition_id") == F.col("__cid")) & (F.col("season_id") == F.col("__sid"))
    joined = totals.join(dimension, on).drop("__cid", "__sid")
    return joined.withColumnsRenamed({f"__c_{c}": c for c in extra})


def current_standings(standings: DataFrame, competitions: DataFrame) -> DataFrame:
    """Tables of the current seasons in competition, stage, group and position order."""
    rows = _current_totals(standings, competitions, ["current_matchday", "season_end_date"])
    shown = [
        "competition_name", "competition_code", "stage", "group_name", "position", "team_name", "team_tla",
        "played_games", "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_difference",
        "form", "current_matchday", "season_end_date",
    ]
    ordered = rows.orderBy(*_up("competition_id", "stage", "group_name", "position", "team_id"))
    return ordered.select(*shown)


def top_teams(standings: DataFrame, competitions: DataFrame, best: int = 5, limit: int = 100) -> DataFrame:
    """The best places of every current table with per-game figures."""
    rows = _current_totals(standings, competitions, []).where(F.col("position") <= best)
    ranked = rows.orderBy(
        *_down("points", "goal_difference", "goals_for"), *_up("competition_id", "team_id", "stage", "group_name")
    ).limit(limit)
    return ranked.select(
        "team_name",
        "team_tla",
        "competition_name",
        "position",
        "points",
        "played_games",
        "goal_difference",
        "goals_for",
        E.ratio("points", "played_games", 2).alias("points_per_game"),
        E.ratio("goals_for", "played_games", 2).alias("goals_per_game"),
        "form",
    )


def competition_summary(standings: DataFrame, competitions: DataFrame) -> DataFrame:
    """Team count, goals and point range of each competition's current season.

    Standings are aggregated per competition and season before the join, so no competition, however
    large, meets the join as more than one row. Competitions without standings stay, with 0 teams.
    """
    totals = standings.where("standing_type = 'TOTAL'").groupBy(
        F.col("competition_id").alias("__cid"), F.col("season_id").alias("__sid")
    )
    figures = totals.agg(
        F.count_distinct("team_id").alias("teams"),
        F.sum("goals_for").alias("total_goals"),
        F.round(
            F.try_divide(F.avg(F.col("goals_for") + F.col("goals_against")), F.avg("played_games")), 2
        ).alias("avg_goals_per_game"),
        F.max("points").alias("max_points"),
        F.min("points").alias("min_points"),
    )
    on = (F.col("competition_id") == F.col("__cid")) & (F.col("current_season_id") == F.col("__sid"))
    shown = [
        "competition_id", "competition_name", "competition_code", "competition_type", "area_name",
        "current_matchday", "season_start_date", "season_end_date",
    ]
    joined = competitions.join(figures, on, "left").select(
        *shown,
        F.coalesce("teams", F.lit(0)).cast("bigint").alias("total_teams"),
        "total_goals",
        "avg_goals_per_game",
        "max_points",
        "min_points",
    )
    return joined.orderBy(*_up("competition_name", "competition_id"))


def home_away(standings: DataFrame, competitions: DataFrame) -> DataFrame:
    """Home against away results of every team in the current season."""
    key = ["competition_id", "season_id", "team_id"]

    def side(kind: str) -> DataFrame:
        measures = ("points", "goals_for", "goals_against")
        rows = standings.where(F.col("standing_type") == kind.upper())
        named = [F.col(m).alias(f"{kind}_{m}") for m in measures]
        return rows.select(*key, *(["team_name"] if kind == "home" else []), *named)

    current = competitions.select("competition_id", F.col("current_season_id").alias("season_id"), "competition_name")
    total = F.col("home_points") + F.col("away_points")
    both = side("home").join(side("away"), key).join(current, ["competition_id", "season_id"])
    shown = both.select(
        *key,
        "team_name",
        "competition_name",
        "home_points",
        "away_points",
        total.alias("total_points"),
        "home_goals_for",
        "away_goals_for",
        "home_goals_against",
        "away_goals_against",
        (F.col("home_points") - F.col("away_points")).alias("home_advantage"),
        E.leader("home_points", "away_points", "Stronger at home", "Stronger away", "Balanced").alias(
            "performance_type"
        ),
    )
    return shown.orderBy(*_down("total_points"), *_up("competition_id", "team_id")).drop(*key)


def competition_rankings(standings: DataFrame, competitions: DataFrame, audit: bool = True) -> DataFrame:
    """Current tables with per-game figures, win share and rank by points, difference and goals."""
    rows = _current_totals(standings, competitions, ["current_matchday", "area_name"])
    ranked = partition_rank(
        rows, ["competition_id", "season_id", "stage"], ["points", "goal_difference", "goals_for"], "overall_rank"
    )
    shown = [
        "competition_id", "competition_name", "competition_code", "season_id", "stage", "group_name",
        "position", "team_id", "team_name", "team_tla", "team_crest_url", "played_games", "won", "draw",
        "lost", "points", "goals_for", "goals_against", "goal_difference", "form", "current_matchday",
        "area_name",
    ]
    per_game = {
        "points_per_game": E.ratio("points", "played_games", 2),
        "goals_scored_per_game": E.ratio("goals_for", "played_games", 2),
        "goals_conceded_per_game": E.ratio("goals_against", "played_games", 2),
        "win_percentage": E.ratio("won", "played_games", 1, scale=100.0),
    }
    stamp = [F.current_timestamp().alias("refreshed_at")] if audit else []
    return ranked.select(*shown, *(c.alias(n) for n, c in per_game.items()), "overall_rank", *stamp)


def standings_of(
    standings: DataFrame,
    competition_code: str | None = None,
    stage: str | None = None,
    group_name: str | None = None,
    standing_type: str = "TOTAL",
) -> DataFrame:
    """Table rows of one competition, stage or group, ordered by group and position."""
    rows = standings.where(F.col("standing_type") == standing_type)
    for name, value in (("competition_code", competition_code), ("stage", stage), ("group_name", group_name)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows.orderBy(*_up("group_name", "position", "competition_id", "season_id", "team_id"))


def best_by_points(standings: DataFrame, limit: int = 10) -> DataFrame:
    """Teams with the most points in any table."""
    totals = standings.where("standing_type = 'TOTAL'")
    best = totals.orderBy(
        *_down("points", "goal_difference"), *_up("competition_id", "season_id", "team_id", "stage", "group_name")
    ).limit(limit)
    return best.select("team_name", "competition_name", "position", "points", "goal_difference")


def rankings_of(rankings: DataFrame, competition_code: str, limit: int = 20) -> DataFrame:
    rows = rankings.where(F.col("competition_code") == competition_code)
    return rows.orderBy(*_up("position", "stage", "group_name", "team_id")).limit(limit)


# ---- live events ------------------------------------------------------------------------------


def current_live(events: DataFrame) -> DataFrame:
    """Newest live event of every match with score line and leader, newest first."""
    shown = [
        "match_id", "event_timestamp", "competition_name", "home_team_name", "away_team_name", "home_score",
        "away_score", "total_goals", "status", "minute", "venue",
    ]
    live = events.where(F.col("is_live")).select(*shown)
    newest = latest_by_key(live, ["match_id"], "event_timestamp")
    return newest.select(
        "match_id",
        "competition_name",
        "home_team_name",
        "away_team_name",
        "home_score",
        "away_score",
        "total_goals",
        E.scoreline("home_team_name", "home_score", "away_score", "away_team_name").alias("match_summary"),
        E.leader("home_score", "away_score", F.col("home_team_name"), F.col("away_team_name"), F.lit("DRAW")).alias(
            "leading_team"
        ),
        "status",
        "minute",
        "venue",
        F.col("event_timestamp").alias("last_updated"),
    ).orderBy(*_down("last_updated"), *_up("match_id"))


def score_progression(events: DataFrame) -> DataFrame:
    """Every event in match and time order."""
    shown = [
        "match_id", "event_timestamp", "minute", "home_team_name", "away_team_name", "home_score",
        "away_score", "total_goals", "match_result", "competition_name",
    ]
    return events.select(*shown).orderBy(*_up("match_id", "event_timestamp"))


def competition_live_summary(events: DataFrame) -> DataFrame:
    """Matches, goals and live events per competition."""
    grouped = events.groupBy("competition_name", "competition_code").agg(
        F.count_distinct("match_id").alias("total_matches"),
        F.sum("total_goals").alias("total_goals"),
        F.round(F.avg("total_goals"), 2).alias("avg_goals_per_match"),
        F.max("total_goals").alias("max_goals_in_match"),
        F.count_if(F.col("is_live")).alias("currently_live"),
    )
    return grouped.orderBy(*_down("total_matches"), *_up("competition_code", "competition_name"))


def recent_events(events: DataFrame, as_of: dt.datetime | str | None = None, span: str = "1 hour") -> DataFrame:
    """Events of the last ``span`` before ``as_of`` (now by default), newest first."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast(events.schema["event_timestamp"].dataType)
    recent = events.where(F.col("event_timestamp") > now - F.expr(f"INTERVAL {span}"))
    return recent.orderBy(*_down("event_timestamp"), *_up("match_id"))


# ---- matches ----------------------------------------------------------------------------------


def live_lines(matches: DataFrame, status: str = "IN_PLAY") -> DataFrame:
    """One line of text per match being played, most recently updated first."""
    rows = matches.where(F.col("status") == status)
    line = E.scoreline("home_team_name", "ft_home_goals", "ft_away_goals", "away_team_name")
    ordered = rows.orderBy(*_down("last_updated"), *_up("match_id"))
    return ordered.select("match_id", "competition_name", line.alias("match"), "status", "last_updated")


def home_wins(matches: DataFrame, competition: str | None = None) -> DataFrame:
    """Matches and wins of home teams, optionally in one competition."""
    rows = matches if competition is None else matches.where(F.col("competition_name") == competition)
    return rows.groupBy("home_team_name").agg(
        F.count(F.lit(1)).alias("matches"), F.count_if(F.col("winner") == "HOME_TEAM").alias("wins")
    )


def home_matches(matches: DataFrame, team: str, status: str = "FINISHED") -> DataFrame:
    """A team's home matches in one status, newest first."""
    rows = matches.where((F.col("home_team_name") == team) & (F.col("status") == status))
    return rows.orderBy(*_down("utc_date"), *_up("match_id"))


def team_logos(matches: DataFrame) -> DataFrame:
    """Logo address taken from the team's JSON details."""
    logo = F.get_json_object("home_team_details", "$.crest")
    return matches.select("match_id", "home_team_name", logo.alias("logo_url"))


# ---- across tables ----------------------------------------------------------------------------


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table as one result."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def build_player_views(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The named views over the gold tables."""
    profile = gold["player_analytics_360"]
    return {
        "vw_top_players": top_players(profile),
        "vw_high_value_low_risk_players": high_value_low_risk(profile),
        "vw_transfer_opportunities": transfer_opportunities(profile, gold["transfer_intelligence"]),
        "mvw_position_statistics": position_statistics(profile),
        "mvw_age_group_analysis": age_group_analysis(profile),
    }


def build_standing_views(standings: DataFrame, competitions: DataFrame) -> dict[str, DataFrame]:
    return {
        "vw_current_standings": current_standings(standings, competitions),
        "vw_top_teams": top_teams(standings, competitions),
        "vw_competition_summary": competition_summary(standings, competitions),
        "vw_team_home_away_comparison": home_away(standings, competitions),
        "mv_competition_rankings": competition_rankings(standings, competitions),
    }


def build_live_views(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "vw_current_live_matches": current_live(events),
        "vw_match_score_progression": score_progression(events),
        "mvw_competition_summary": competition_live_summary(events),
    }


def register_all(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Make views available to SQL; returns their names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
