"""Per-player metrics and the combined profile.

Each metric is one hash aggregation: partial sums are made before the shuffle, so a player with a
third of all rows costs one row per map task. All outputs are keyed by ``player_id`` and leave their
aggregation partitioned by it, so the joins of ``profile_360`` need no further shuffle of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statforge.functions import expr as E
from statforge.operators.dedup import first_by_key
from statforge.operators.ranking import global_rank
from statforge.operators.timeline import with_neighbours
from statforge.session import stored

KEY = "player_id"
CALCULATED_AT = "gold_processed_timestamp"

# Fixed values of the score definitions.
GOALS_PER_90_CAP = 3.0
FULL_CONTRIBUTION_PER_90 = 2.0
FULL_MARKET_VALUE = 100_000_000
WORST_SEVERITY = 10.0
SCORE_WEIGHTS = {"performance_score": 0.4, "market_score": 0.3, "health_score": 0.3}
RISK_LEVELS = ((5, "HIGH"), (2, "MEDIUM"))


def _stamped(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn(CALCULATED_AT, F.current_timestamp()) if audit else df


def form_metrics(performances: DataFrame, audit: bool = True) -> DataFrame:
    """Appearances, goals, assists, cards and rates per player over all season rows."""
    sums = {
        "total_appearances": F.sum("nb_on_pitch"),
        "total_goals": F.sum("goals"),
        "total_assists": F.sum("assists"),
        "total_yellow_cards": F.sum("yellow_cards"),
        "total_red_cards": F.sum("second_yellow_cards") + F.sum("direct_red_cards"),
        "total_minutes_played": F.sum("minutes_played"),
        "avg_goals_per_season": F.round(F.avg("goals"), 2),
        "avg_assists_per_season": F.round(F.avg("assists"), 2),
        "best_goals_season": F.max("goals"),
        "best_assists_season": F.max("assists"),
    }
    totals = performances.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_seasons"), *(c.alias(n) for n, c in sums.items())
    )
    return _stamped(
        totals.select(
            "*",
            E.per_90("total_goals", "total_minutes_played", GOALS_PER_90_CAP).alias("goals_per_90min"),
            E.per_90("total_assists", "total_minutes_played", GOALS_PER_90_CAP).alias("assists_per_90min"),
            (F.col("total_goals") + F.col("total_assists")).alias("goal_contributions"),
        ),
        audit,
    )


def value_timeline(values: DataFrame, tie: str | None = None) -> DataFrame:
    """Every valuation with its neighbours, change, percentage change and direction."""
    rows = with_neighbours(values, KEY, "date_unix", "value", tie)
    change = F.col("value") - F.col("prev_value")
    return rows.select(
        "*",
        change.alias("value_change"),
        E.pct_change("value", "prev_value").alias("value_change_pct"),
        E.direction(change).alias("trend_direction"),
    )


def value_change(values: DataFrame, as_of: str, years: tuple[int, ...] = (1, 3), audit: bool = True) -> DataFrame:
    """The value at ``as_of`` per player, and by how much it differs from that of each number of years before.

    The value at a day is the last one dated on it or earlier. A change is NULL without a value that old; a player without any value
    at ``as_of`` has no row. Cleaned valuations are unique per player and date. One aggregation: the days are conditions in it.
    """
    day = F.lit(str(as_of)).cast("date")

    def value_at(limit: Column) -> Column:
        dated = F.col("date_unix") <= limit
        return F.max_by(F.when(dated, F.col("value")), F.when(dated, F.col("date_unix"))).cast("bigint")

    found = values.groupBy(KEY).agg(
        value_at(day).alias("current_market_value"), *(value_at(F.add_months(day, -12 * n)).alias(f"value_{n}y_ago") for n in years)
    )
    changes = ((F.col("current_market_value") - F.col(f"value_{n}y_ago")).alias(f"value_change_{n}y") for n in years)
    return _stamped(found.where("current_market_value IS NOT NULL").select("*", *changes), audit)


def recent_form(performances: DataFrame, seasons: int = 3, audit: bool = True) -> DataFrame:
    """Goals, assists, minutes and rates of each player's last season and last ``seasons`` seasons.

    Rows are first summed per player and season, which splits a player of many rows; a season's place then comes from one row a season. Seasons are
    ordered by name, the last first; a NULL season is the oldest.
    """
    summed = ("goals", "assists", "minutes_played")
    by_season = performances.groupBy(KEY, "season_name").agg(*(F.sum(c).cast("bigint").alias(c) for c in summed))
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(F.col("season_name").desc_nulls_last()))
    placed = by_season.withColumn("place", place).where(F.col("place") <= seasons)

    def total(column: str, last: int) -> Column:
        return F.sum(F.when(F.col("place") <= last, F.col(column)))

    short = {"goals": "goals", "assists": "assists", "minutes_played": "minutes"}
    spans = {"last_season": 1, f"last_{seasons}_seasons": seasons}
    sums = [total(c, last).alias(f"{name}_{short[c]}") for name, last in spans.items() for c in summed]
    totals = placed.groupBy(KEY).agg(F.max(F.when(F.col("place") == 1, F.col("season_name"))).alias("last_season"), F.count(F.lit(1)).alias("seasons_counted"), *sums)
    rates = [
        E.per_90(f"{name}_{what}", f"{name}_minutes", GOALS_PER_90_CAP).alias(f"{name}_{what}_per_90") for name in spans for what in ("goals", "assists")
    ]
    shares = [(F.col(f"{name}_goals") + F.col(f"{name}_assists")).alias(f"{name}_goal_participation") for name in spans]
    return _stamped(totals.select("*", *rates, *shares), audit)


def value_summary(values: DataFrame, tie: str | None = None, audit: bool = True) -> DataFrame:
    """Peak, lowest, average and latest value per player.

    The latest value comes from ``max_by`` in the same aggregation. Cleaned valuations are unique per
    player and date; for others name a ``tie`` column, whose largest value wins among equal dates.
    NULL dates count as the oldest, and only a player without any date falls back to those rows.
    """
    if tie is None:
        dated = F.max_by("value", "date_unix")
        latest: Column = F.coalesce(dated, F.max(F.when(F.col("date_unix").isNull(), F.col("value"))))
    else:
        latest = F.max_by("value", F.struct("date_unix", tie))
    grouped = values.groupBy(KEY).agg(
        F.max("value").cast("bigint").alias("peak_market_value"),
        F.min("value").cast("bigint").alias("lowest_market_value"),
        F.avg("value").try_cast("bigint").alias("avg_market_value"),
        F.count(F.lit(1)).alias("value_records_count"),
        latest.cast("bigint").alias("latest_market_value"),
        F.max("date_unix").alias("latest_valuation_timestamp"),
    )
    spread = F.col("peak_market_value") - F.col("lowest_market_value")
    return _stamped(grouped.withColumn("value_volatility", spread), audit)


def injury_risk(injuries: DataFrame, audit: bool = True) -> DataFrame:
    """Injury totals, averages, severity (from counts and days) and the risk level it implies."""
    totals = injuries.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_injuries"),
        *(F.sum(f"{unit}_missed").alias(f"total_{unit}_missed") for unit in ("days", "games")),
        *(F.round(F.avg(f"{unit}_missed"), 2).alias(f"avg_{unit}_per_injury") for unit in ("days", "games")),
        *(F.max(f"{unit}_missed").alias(f"longest_injury_{unit}") for unit in ("days", "games")),
    )
    points = F.col("total_injuries") * 5 + F.col("total_days_missed") / 10
    scored = totals.withColumn("injury_severity_score", F.round(points / 100, 2))
    level = E.label_by_floor("injury_severity_score", RISK_LEVELS, "LOW")
    return _stamped(scored.withColumn("injury_risk_level", level), audit)


def transfer_intelligence(transfers: DataFrame, audit: bool = True) -> DataFrame:
    """Fee and value statistics per player. Fees that are not numbers count as unknown.

    Fees are summed as decimals, so the truncated totals do not depend on row order.
    """
    fee = E.money(E.lenient_double("transfer_fee"))
    facts = transfers.select(KEY, "date", "value_at_transfer", fee.alias("fee"))
    totals = facts.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_transfers"),
        *(
            stat("fee").try_cast("bigint").alias(name)
            for name, stat in (
                ("total_transfer_fees", F.sum),
                ("avg_transfer_fee", F.avg),
                ("highest_transfer_fee", F.max),
            )
        ),
        F.avg("value_at_transfer").try_cast("bigint").alias("avg_value_at_transfer"),
        F.max("date").alias("last_transfer_date"),
    )
    profit = F.col("total_transfer_fees") > F.col("avg_value_at_transfer")
    return _stamped(
        totals.select(
            "*",
            F.round(F.col("total_transfers") / 10, 2).alias("transfer_frequency"),
            F.when(profit, "PROFIT").otherwise("LOSS").alias("transfer_value_trend"),
        ),
        audit,
    )


def _or(column: Column, default: float) -> Column:
    return F.round(F.coalesce(column, F.lit(default)), 2)


def add_scores(df: DataFrame) -> DataFrame:
    """Performance, market and health score (0-100) and their weighted sum.

    A player without performances or valuations scores 0 there; one without injuries is fully healthy.
    """
    per_90 = F.col("goals_per_90min") + F.col("assists_per_90min")
    per_point = 100.0 / FULL_CONTRIBUTION_PER_90
    performance = F.when(per_90 > FULL_CONTRIBUTION_PER_90, 100.0).otherwise(per_90 * per_point)
    peak = F.col("peak_market_value")
    market = F.when(peak > FULL_MARKET_VALUE, 100.0).otherwise(peak / (FULL_MARKET_VALUE / 100.0))
    severity = F.col("injury_severity_score")
    health = F.when(severity >= WORST_SEVERITY, 0.0).otherwise(100.0 - severity * (100.0 / WORST_SEVERITY))
    scored = df.withColumns(
        {
            "performance_score": _or(performance, 0.0),
            "market_score": _or(market, 0.0),
            "health_score": _or(health, 100.0),
        }
    )
    first, *rest = (F.col(name) * weight for name, weight in SCORE_WEIGHTS.items())
    return scored.withColumn("overall_player_score", F.round(sum(rest, first), 2))


# The columns of the combined profile, in order, with the type the table gives them.
PROFILE_360_COLUMNS = (
    ("player_id", None),
    ("player_name", None),
    ("date_of_birth", None),
    ("age", None),
    ("player_main_position", None),
    ("citizenship", None),
    ("current_club_id", "bigint"),
    ("height", "int"),
    ("foot", None),
    ("total_appearances", None),
    ("total_goals", None),
    ("total_assists", None),
    ("goals_per_90min", None),
    ("assists_per_90min", None),
    ("goal_contributions", None),
    ("avg_goals_per_season", None),
    ("avg_assists_per_season", None),
    ("peak_market_value", "bigint"),
    ("latest_market_value", "bigint"),
    ("avg_market_value", "bigint"),
    ("value_volatility", "bigint"),
    ("latest_valuation_timestamp", None),
    ("total_injuries", None),
    ("total_days_missed", "int"),
    ("injury_severity_score", None),
    ("injury_risk_level", None),
    ("total_transfers", None),
    ("total_transfer_fees", "bigint"),
    ("avg_transfer_fee", "bigint"),
    ("last_transfer_date", None),
    ("performance_score", None),
    ("market_score", None),
    ("health_score", None),
    ("overall_player_score", None),
    ("player_rank", None),
    ("player_rank_percentile", None),
)


def join_metrics(
    profiles: DataFrame, form: DataFrame, values: DataFrame, injuries: DataFrame, transfers: DataFrame
) -> DataFrame:
    """Left-join the four per-player metrics onto the profiles; every side is unique per player."""
    joined = profiles
    for metric in (form, values, injuries, transfers):
        joined = joined.join(metric.drop(CALCULATED_AT), KEY, "left")
    return joined


def _scored_rows(profiles: DataFrame, metrics: Sequence[DataFrame], as_of: dt.date | str | None) -> DataFrame:
    """All players with their metrics, age and scores."""
    wanted = [
        KEY,
        "player_name",
        "date_of_birth",
        F.col("position").alias("player_main_position"),
        "citizenship",
        "current_club_id",
        "height",
        "foot",
    ]
    rows = join_metrics(profiles.select(*wanted), *metrics)
    return add_scores(rows.withColumn("age", E.age_years("date_of_birth", as_of)))


def _shown(rows: DataFrame) -> DataFrame:
    """Players with an id and a name, in the columns and types of the combined profile (those of its columns that ``rows`` has)."""
    named = rows.where(F.col("player_name").isNotNull() & F.col(KEY).isNotNull())
    return named.select(
        *(F.col(n) if t is None else F.col(n).try_cast(t).alias(n) for n, t in PROFILE_360_COLUMNS if n in rows.columns)
    )


def scored_profile(
    profiles: DataFrame,
    form: DataFrame,
    values: DataFrame,
    injuries: DataFrame,
    transfers: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The combined profile without rank and percentile: one plan of joins, with nothing sorted or stored, and columns pruned."""
    return _shown(_scored_rows(profiles, (form, values, injuries, transfers), as_of))


def profile_360(
    profiles: DataFrame,
    form: DataFrame,
    values: DataFrame,
    injuries: DataFrame,
    transfers: DataFrame,
    as_of: dt.date | str | None = None,
    audit: bool = True,
    materialise: Callable[[DataFrame], DataFrame] = stored,
) -> DataFrame:
    """All metrics of every player with scores, rank and percentile.

    Ranks are given before players without a name are dropped, so those leave gaps. Ranking reads its
    input twice (to count and to place), so the joined rows are written once with ``materialise``.
    """
    rows = materialise(_scored_rows(profiles, (form, values, injuries, transfers), as_of))
    ranked = global_rank(rows, "overall_player_score", KEY, "player_rank", "player_rank_percentile")
    return _stamped(_shown(ranked), audit)


def latest_value(values: DataFrame) -> DataFrame:
    """The newest valuation row of each player, as a row operation."""
    return first_by_key(values, [KEY], [F.col("date_unix").desc_nulls_last()])
