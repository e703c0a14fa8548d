"""The quality rules of the raw, cleaned and metric tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.functions import expr as E
from statforge.operators import quality as Q
from statforge.operators.quality import ERROR, INFO, WARNING, Rule, holds
from statforge.sinks.files import Snapshot
from statforge.sources.files import verify_layer


def _non_negative(*columns: str, severity: str = ERROR) -> list[Rule]:
    return [Rule(f"{c}_negative", F.col(c) < 0, severity) for c in columns]


def profile_rules(as_of: dt.date | str | None = None) -> list[Rule]:
    born = E.lenient_date("date_of_birth")
    return [
        Rule("height_unusual", E.lenient_double("height") < 140, WARNING),
        Rule("birth_in_future", born > E.as_date(as_of), WARNING),
        Rule("birth_before_1930", born < F.lit("1930-01-01").cast("date"), WARNING),
    ]


PERFORMANCE_STATS = ("goals", "assists", "minutes_played", "yellow_cards")


def performance_rules() -> list[Rule]:
    return [
        *_non_negative(*PERFORMANCE_STATS),
        Rule("penalty_goals_above_goals", F.col("penalty_goals") > F.col("goals"), WARNING),
        Rule("second_yellow_above_yellow", F.col("second_yellow_cards") > F.col("yellow_cards"), WARNING),
    ]


def value_rules() -> list[Rule]:
    return [Rule("value_mostly_zero", F.col("value") == 0, WARNING, over_share=0.5), *_non_negative("value")]


def injury_rules() -> list[Rule]:
    starts, ends = E.lenient_date("from_date"), E.lenient_date("end_date")
    return [Rule("ends_before_start", ends < starts, ERROR), *_non_negative("days_missed", severity=WARNING)]


def transfer_rules() -> list[Rule]:
    fee = E.lenient_double("transfer_fee")
    return [
        Rule("from_team_is_to_team", F.col("from_team_id") == F.col("to_team_id"), WARNING),
        Rule("transfer_fee_negative", fee < 0, WARNING),
        Rule("free_transfer", fee == 0, INFO),
    ]


# Columns the raw profiles must have; keys that must be unique.
PROFILE_COLUMNS = ("player_id", "player_slug", "player_name")


# What the columns of the raw tables must read as.
_COUNTS = dict.fromkeys(("goals", "assists", "yellow_cards", "penalty_goals", "second_yellow_cards", "clean_sheets"), Q.INT)
SOURCE_FAMILIES: dict[str, dict[str, str]] = {
    "player_profiles": {"player_id": Q.INT, "date_of_birth": Q.DATE, "height": Q.FLOAT, "contract_expires": Q.DATE},
    "player_performances": {"player_id": Q.INT, **_COUNTS, "nb_on_pitch": Q.INT, "minutes_played": Q.FLOAT, "goals_conceded": Q.INT},
    "player_market_value": {"player_id": Q.INT, "date_unix": Q.DATE, "value": Q.FLOAT},
    "player_latest_market_value": {"player_id": Q.INT, "latest_market_value": Q.FLOAT, "value_date": Q.DATE},
    "player_injuries": {"player_id": Q.INT, "from_date": Q.DATE, "end_date": Q.DATE, "days_missed": Q.FLOAT, "games_missed": Q.INT},
    "player_national_performances": {"player_id": Q.INT, "debut": Q.DATE, "matches": Q.INT, "goals": Q.INT},
    "player_teammates_played_with": {"player_id": Q.INT, "ppg_played_with": Q.FLOAT, "joint_goal_participation": Q.INT, "minutes_played_with": Q.FLOAT},
    "transfer_history": {"player_id": Q.INT, "transfer_date": Q.DATE, "value_at_transfer": Q.FLOAT, "transfer_fee": Q.FLOAT},
    "team_competitions_seasons": {"season_draws": Q.INT, "season_wins": Q.INT, "season_losses": Q.INT, "season_points": Q.INT},
}


def check_sources(raw: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> DataFrame:
    """Findings over the raw tables that are present, always on all rows.

    Row rules, columns that are mostly missing and values that don't read as their column's family are counted in one scan of each table;
    unique keys take a grouping of their own.
    """
    found = []
    row_rules = {
        "player_profiles": profile_rules(as_of),
        "player_performances": performance_rules(),
        "player_market_value": value_rules(),
        "player_injuries": injury_rules(),
        "transfer_history": transfer_rules(),
    }
    for table, df in raw.items():
        # Row rules compare numbers; shares and families are of the text as it came.
        as_text = [*Q.missing_share(*df.columns), *Q.family_rules(df, SOURCE_FAMILIES.get(table, {}))]
        flags = {f"__text{i}": rule.condition() for i, rule in enumerate(as_text)}
        flagged = _numeric(df.withColumns(flags), table)
        as_text = [dataclasses.replace(rule, bad=F.col(name)) for rule, name in zip(as_text, flags)]
        found.append(Q.check_rows(flagged, table, [*row_rules.get(table, ()), *as_text]))
    if "player_profiles" in raw:
        found.append(Q.required_columns(raw["player_profiles"], "player_profiles", PROFILE_COLUMNS))
        found.append(Q.duplicate_keys(raw["player_profiles"], "player_profiles", ["player_id"]))
    if "team_details" in raw:
        found.append(Q.duplicate_keys(raw["team_details"], "team_details", ["club_id"]))
    return Q.combine(found)


def check_snapshots(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """Findings over stored snapshots, from the versions on disk: there is one, it has rows, and by how many rows it differs from the last.

    Counts come from the Parquet footers. A snapshot without a committed version has 0 rows in all three findings.
    """
    found = []
    for name in names:
        snapshot = Snapshot(spark, root, name)
        versions = snapshot.versions()
        rows, *before = [snapshot.read(v).count() for v in versions[:-3:-1]] or [0]
        changed = abs(rows - before[0]) if before else 0
        found += [
            (name, "stored", ERROR, int(not versions), rows),
            (name, "has_rows", WARNING, int(rows == 0), rows),
            (name, "rows_changed", INFO, changed, rows),
        ]
    return spark.createDataFrame(found, Q.FINDING)


def check_layer(spark: SparkSession, root: str, tables: Iterable[str]) -> DataFrame:
    """Findings over a stored layer: every table can be read, and how many rows it has."""
    report = verify_layer(spark, root, list(tables))
    return spark.createDataFrame([(r["table"], "readable", ERROR, int(r["status"] != "OK"), r.get("rows") or 0) for r in report], Q.FINDING)


_NUMERIC = {
    "player_performances": (*PERFORMANCE_STATS, "penalty_goals", "second_yellow_cards"),
    "player_market_value": ("value",),
    "player_injuries": ("days_missed",),
}


def _numeric(df: DataFrame, table: str) -> DataFrame:
    """Text numbers of a raw table as doubles, so that comparisons are numeric."""
    return df.withColumns({c: E.lenient_double(c) for c in _NUMERIC.get(table, ()) if c in df.columns})


# CHECK constraints of the metric tables.
CONSTRAINTS: dict[str, list[Rule]] = {
    "player_form_metrics": [
        holds(f"{c}_positive", f"{c} >= 0")
        for c in ("total_seasons", "total_appearances", "total_goals", "goals_per_90min")
    ],
    "market_value_trends": [
        *(
            holds(f"{c}_positive", f"{c} >= 0")
            for c in ("peak_market_value", "latest_market_value", "lowest_market_value", "value_records_count")
        ),
        holds("peak_gte_lowest", "peak_market_value >= lowest_market_value"),
    ],
    "injury_risk_scores": [
        *(holds(f"{c}_positive", f"{c} >= 0") for c in ("total_injuries", "total_days_missed")),
        holds("injury_risk_level_known", "injury_risk_level IN ('LOW', 'MEDIUM', 'HIGH')"),
    ],
    "transfer_intelligence": [
        *(holds(f"{c}_positive", f"{c} >= 0") for c in ("total_transfers", "total_transfer_fees")),
        holds("transfer_value_trend_known", "transfer_value_trend IN ('PROFIT', 'LOSS', 'STABLE')"),
    ],
    "player_analytics_360": [
        holds("age_reasonable", "age BETWEEN 14 AND 80"),
        holds("height_reasonable", "height BETWEEN 150 AND 220"),
        *(
            holds(f"{c}_range", f"{c} BETWEEN 0 AND 100")
            for c in (
                "performance_score",
                "market_score",
                "health_score",
                "overall_player_score",
                "player_rank_percentile",
            )
        ),
        holds("injury_risk_level_known", "injury_risk_level IN ('LOW', 'MEDIUM', 'HIGH')"),
    ],
}
MATCH_CONSTRAINTS = [
    holds(
        "status_known",
        "status IN ('SCHEDULED', 'TIMED', 'IN_PLAY', 'PAUSED', 'FINISHED', 'POSTPONED', 'SUSPENDED', 'CANCELLED')",
    )
]
# NOT NULL columns and unique keys of the serving tables.
NOT_NULL = {
    "player_form_metrics": [
        "player_id", "total_seasons", "total_appearances", "total_minutes_played", "total_goals",
        "total_assists", "goal_contributions", "total_yellow_cards", "total_red_cards",
    ],
    "market_value_trends": ["player_id", "peak_market_value", "lowest_market_value", "value_volatility", "value_records_count"],
    "injury_risk_scores": ["player_id", "total_injuries", "total_days_missed", "total_games_missed"],
    "transfer_intelligence": ["player_id", "total_transfers"],
    "player_analytics_360": ["player_id", "player_name"],
    "live_events": ["match_id", "event_timestamp"],
    "competitions": ["competition_id", "competition_name", "competition_code"],
    "leaderboards": ["competition_id", "season_id", "position", "team_id", "team_name"],
}
UNIQUE = {
    **{t: ["player_id"] for t in CONSTRAINTS},
    "live_events": ["match_id", "event_timestamp"],
    "competitions": ["competition_id"],
    "leaderboards": ["competition_id", "season_id", "stage", "standing_type", "team_id", "group_name"],
}


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared constraints: value checks, NOT NULL and unique keys (NULL and '' group are one)."""
    found = []
    for name, df in tables.items():
        rules = [*CONSTRAINTS.get(name, ()), *Q.not_null(*NOT_NULL.get(name, ()))]
        if name == "matches":
            rules += MATCH_CONSTRAINTS
        if rules:
            found.append(Q.check_rows(df, name, rules))
        if name in UNIQUE:
            keyed = df.fillna({"group_name": ""}) if "group_name" in df.columns else df
            found.append(Q.duplicate_keys(keyed, name, UNIQUE[name]))
    return Q.combine(found)


# Types of the metric tables.
PRECISION = {
    "goals_per_90min": "decimal(10,4)",
    "height": "int",
    "peak_market_value": "bigint",
    "performance_score": "decimal(10,2)",
}
# Decimal types of the serving tables.
SERVING_DECIMALS = {
    "avg_goals_per_season": "decimal(10,2)",
    "avg_assists_per_season": "decimal(10,2)",
    "goals_per_90min": "decimal(10,4)",
    "assists_per_90min": "decimal(10,4)",
    "avg_days_per_injury": "decimal(10,2)",
    "avg_games_per_injury": "decimal(10,2)",
    "injury_severity_score": "decimal(10,2)",
    "transfer_frequency": "decimal(10,2)",
    "performance_score": "decimal(10,2)",
    "market_score": "decimal(10,2)",
    "health_score": "decimal(10,2)",
    "overall_player_score": "decimal(10,2)",
    "player_rank_percentile": "decimal(5,2)",
}


# Column types of the serving database.
SERVING_TYPES = {
    "player_form_metrics": """
        player_id bigint, total_seasons int, total_appearances int, total_minutes_played int, total_goals int, total_assists int,
        goal_contributions int, avg_goals_per_season decimal(10,2), avg_assists_per_season decimal(10,2), best_goals_season int,
        best_assists_season int, goals_per_90min decimal(10,4), assists_per_90min decimal(10,4), total_yellow_cards int,
        total_red_cards int""",
    "market_value_trends": """
        player_id bigint, peak_market_value bigint, latest_market_value bigint, lowest_market_value bigint, avg_market_value bigint,
        value_volatility bigint, value_records_count int, latest_valuation_timestamp date""",
    "injury_risk_scores": """
        player_id bigint, total_injuries int, total_days_missed int, total_games_missed int, avg_days_per_injury decimal(10,2),
        avg_games_per_injury decimal(10,2), longest_injury_days int, longest_injury_games int, injury_severity_score decimal(10,2),
        injury_risk_level varchar(20)""",
    "transfer_intelligence": """
        player_id bigint, total_transfers int, total_transfer_fees bigint, avg_transfer_fee bigint, highest_transfer_fee bigint,
        avg_value_at_transfer bigint, transfer_frequency decimal(10,2), transfer_value_trend varchar(20), last_transfer_date date""",
    "player_analytics_360": """
        player_id bigint, player_name varchar(255), date_of_birth date, age int, player_main_position varchar(50),
        citizenship varchar(100), current_club_id bigint, height int, foot varchar(20), total_appearances int, total_goals int,
        total_assists int, goals_per_90min decimal(10,4), assists_per_90min decimal(10,4), goal_contributions int,
        avg_goals_per_season decimal(10,2), avg_assists_per_season decimal(10,2), peak_market_value bigint,
        latest_market_value bigint, avg_market_value bigint, value_volatility bigint, latest_valuation_timestamp date,
        total_injuries int, total_days_missed int, injury_severity_score decimal(10,2), injury_risk_level varchar(20),
        total_transfers int, total_transfer_fees bigint, avg_transfer_fee bigint, last_transfer_date date,
        performance_score decimal(10,2), market_score decimal(10,2), health_score decimal(10,2), overall_player_score decimal(10,2),
        player_rank int, player_rank_percentile decimal(5,2)""",
}


def declared(table: str) -> dict[str, str]:
    """The declared column types of a serving table, by column."""
    parts = re.findall(r"(\w+) (\w+(?:\([\d,]+\))?)", SERVING_TYPES[table])
    return dict(parts)


def check_declared(df: DataFrame, table: str) -> DataFrame:
    """Findings of a metric table against its declared types, in one scan.

    A missing column counts every row. Of the others it counts values that the declared type can't hold: numbers out of its range, text
    that is too long or doesn't read as the type. Rounding to the declared decimals is no finding; NULL fits every type.
    """
    rules = []
    for column, kind in declared(table).items():
        if column not in df.columns:
            rules.append(Rule(f"has({column} {kind})", F.lit(True), ERROR))
            continue
        limit = re.fullmatch(r"varchar\((\d+)\)", kind)
        value = F.col(column)
        lost = F.length(value.cast("string")) > int(limit[1]) if limit else value.isNotNull() & value.try_cast(kind).isNull()
        rules.append(Rule(f"fits({column} {kind})", lost, ERROR))
    return Q.check_rows(df, table, rules)


def serving_types(df: DataFrame) -> DataFrame:
    """A metric table with the decimal types of the serving database."""
    wanted = {c: t for c, t in SERVING_DECIMALS.items() if c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in wanted.items()}) if wanted else df


def range_rules() -> dict[str, list[Rule]]:
    return {
        "player_form_metrics": [
            Rule("rate_above_cap", (F.col("goals_per_90min") > 3.0) | (F.col("assists_per_90min") > 3.0), ERROR)
        ],
        "player_analytics_360": [
            Rule("goals_rate_above_cap", F.col("goals_per_90min") > 3.0, ERROR),
            Rule("assists_rate_above_cap", F.col("assists_per_90min") > 3.0, ERROR),
            Rule("performance_out_of_range", ~F.col("performance_score").between(0, 100), ERROR),
            *Q.not_null("player_id", "player_name", "overall_player_score"),
            Rule("height_often_missing", F.col("height").isNull(), WARNING, over_share=0.05),
            Rule("goals_rate_often_missing", F.col("goals_per_90min").isNull(), WARNING, over_share=0.30),
        ],
        "market_value_trends": [Rule("peak_negative", F.col("peak_market_value") < 0, ERROR)],
    }


def validate(
    gold: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    views: Mapping[str, DataFrame] | None = None,
    expected_rows: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Findings over the finished tables: types, values that the declared types can't hold, ranges, NULLs, duplicates, references, views, and sizes where ranges are given."""
    found = [Q.check_rows(gold[t], t, rules) for t, rules in range_rules().items() if t in gold]
    profile = gold["player_analytics_360"]
    found.append(Q.expected_types(serving_types(profile), "player_analytics_360", PRECISION))
    found += [check_declared(df, t) for t, df in gold.items() if t in SERVING_TYPES]
    found.append(Q.duplicate_keys(profile, "player_analytics_360", ["player_id"], ERROR))
    if "player_performances" in silver:
        found.append(
            Q.duplicate_keys(silver["player_performances"], "player_performances", ["player_id", "season_name"], WARNING)
        )
    if "player_profiles" in silver:
        found.append(
            Q.check_references(profile, "player_analytics_360", silver["player_profiles"], {"player_id": "player_id"})
        )
    found += [Q.check_size(gold[t], t, low, high) for t, (low, high) in (expected_rows or {}).items() if t in gold]
    found += [Q.not_empty(df, name) for name, df in (views or {}).items()]
    return Q.combine(found)
