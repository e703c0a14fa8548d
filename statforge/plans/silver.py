"""The ten cleaned tables, as column rules."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statforge.operators.cleaning import (
    CleanSpec,
    centimetres,
    clean,
    count,
    day,
    first_of,
    ident,
    keep,
    key_day,
    number,
    spec,
    text,
)

# Output columns, their order, defaults and required keys of each cleaned table.
SILVER: dict[str, CleanSpec] = {
    "player_profiles": spec(
        ident("player_id"),
        text("player_slug"),
        first_of("player_name", "player_name", "player_slug"),
        keep("player_image_url"),
        day("date_of_birth"),
        text("place_of_birth", "country_of_birth", default="Unknown"),
        centimetres("height"),
        keep("citizenship"),
        text("citizenship", to="citizenship_country", default="Unknown"),
        text("position", default="Unknown"),
        text("foot", default="UNKNOWN", upper=True),
        text("current_club_id"),
        day("joined", "contract_expires"),
        keep("social_media_url"),
        text("main_position", to="player_main_position"),
        required=("player_id",),
        unique=("player_id",),
    ),
    "player_performances": spec(
        ident("player_id"),
        text("season_name", "competition_id", "competition_name", "team_id", "team_name"),
        count("nb_in_group", "nb_on_pitch", "goals", "own_goals", "assists", "subed_in", "subed_out"),
        count("yellow_cards", "second_yellow_cards", "direct_red_cards", "penalty_goals"),
        count("minutes_played", "goals_conceded", "clean_sheets"),
        required=("player_id", "season_name"),
    ),
    "player_market_value": spec(
        ident("player_id"),
        key_day("date_unix"),
        count("value"),
        required=("player_id",),
        unique=("player_id", "date_unix"),
    ),
    "player_injuries": spec(
        ident("player_id"),
        text("season_name", "injury_reason"),
        day("from_date", "end_date"),
        count("days_missed", "games_missed"),
        required=("player_id",),
    ),
    "player_national_performances": spec(
        ident("player_id"),
        text("team_id"),
        day("debut", to="first_game_date"),
        count("matches", "goals"),
        required=("player_id",),
    ),
    "player_teammates_played_with": spec(
        ident("player_id"),
        text("teammate_player_id"),
        text("teammate_player_name", to="player_with_name"),
        number("ppg_played_with", default=0.0),
        count("joint_goal_participation", "minutes_played_with"),
        required=("player_id", "teammate_player_id"),
    ),
    "transfer_history": spec(
        ident("player_id"),
        text("season_name", to="season"),
        day("transfer_date", to="date"),
        text("from_team_id", "from_team_name", "to_team_id", "to_team_name"),
        count("value_at_transfer"),
        text("transfer_fee"),
        required=("player_id",),
    ),
    "team_details": spec(
        text("club_id", "club_slug", "club_name"),
        keep("logo_url"),
        text("country_name", "season_id", "competition_id", "competition_slug", "competition_name"),
        text("club_division"),
        keep("source_url"),
        required=("club_id",),
        unique=("club_id",),
    ),
    "team_competitions_seasons": spec(
        text("club_id", "competition_id", "competition_name", "team_name", "season_season"),
        count("season_rank", "season_draws", "season_wins", "season_losses", "season_points"),
        count("season_goals_for", "season_goals_against", "season_goal_difference"),
        passthrough=True,
    ),
    "team_children": spec(
        text("parent_team_id", "parent_team_name", "child_team_id", "child_team_name"),
        required=("parent_team_id", "child_team_id"),
    ),
}


def clean_table(name: str, raw: DataFrame, audit: bool = True) -> DataFrame:
    """Cleaned form of one raw table."""
    return clean(raw, SILVER[name], audit)
