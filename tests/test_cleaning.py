import datetime as dt

import pytest

from conftest import one, rows
from statforge.plans.silver import SILVER, clean_table

PROFILE = (
    "player_id string, player_slug string, player_name string, player_image_url string, date_of_birth string, "
    "place_of_birth string, country_of_birth string, height string, citizenship string, position string, foot string, "
    "current_club_id string, joined string, contract_expires string, social_media_url string, main_position string"
)


def profile(**values):
    base = dict.fromkeys(c.split()[0] for c in PROFILE.split(", "))
    return tuple({**base, **values}.values())


def test_profiles(spark):
    raw = spark.createDataFrame(
        [
            profile(player_id="1", player_slug=" slug ", date_of_birth="2000-01-02", height="1.85", foot=" right", citizenship=" X "),
            profile(player_id="2", player_name=" N ", date_of_birth="2020-13-01", height="0", position="  ", joined="x"),
            profile(player_id=None, player_name="gone"),
            profile(player_id="3", player_name="b"),
            profile(player_id="3", player_name="a"),
        ],
        PROFILE,
    )
    out = {r["player_id"]: r for r in clean_table("player_profiles", raw).collect()}
    assert set(out) == {1, 2, 3}
    first = out[1]
    assert (first.player_name, first.date_of_birth, first.height, first.foot) == ("slug", dt.date(2000, 1, 2), 185, "RIGHT")
    assert (first.citizenship, first.citizenship_country, first.place_of_birth, first.position) == (" X ", "X", "Unknown", "Unknown")
    second = out[2]
    assert (second.player_name, second.date_of_birth, second.height, second.foot) == ("N", None, None, "UNKNOWN")
    assert (second.position, second.joined) == ("", None)
    assert out[3].player_name == "a"
    assert clean_table("player_profiles", raw).columns[-1] == "silver_processed_timestamp"


def test_profiles_accept_inferred_types(spark):
    raw = spark.createDataFrame([profile(player_id="1", player_name="x", height="2")], PROFILE)
    typed = raw.selectExpr("* except(date_of_birth, height, current_club_id, joined)", "date'1999-05-06' date_of_birth", "1.9D height", "7 current_club_id", "timestamp'2020-01-01 10:00:00' joined")
    out = one(clean_table("player_profiles", typed, audit=False))
    assert (out["date_of_birth"], out["height"], out["current_club_id"], out["joined"]) == (dt.date(1999, 5, 6), 190, "7", dt.date(2020, 1, 1))


def _all_text(spark, table, *records):
    """Raw table with every column some rule mentions, from partial records."""
    names = list(dict.fromkeys(k for r in records for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ", ".join(f"`{n}` string" for n in names))


STATS = (
    "nb_in_group nb_on_pitch goals own_goals assists subed_in subed_out yellow_cards second_yellow_cards direct_red_cards "
    "penalty_goals minutes_played goals_conceded clean_sheets"
).split()


def test_performances_keep_duplicates_and_need_player_and_season(spark):
    base = {c: "1" for c in STATS} | {"competition_id": " c", "competition_name": None, "team_id": "t", "team_name": ""}
    raw = _all_text(
        spark,
        "player_performances",
        base | {"player_id": "1", "season_name": " 20/21 ", "goals": "abc", "assists": "2.9"},
        base | {"player_id": "1", "season_name": " 20/21 ", "goals": "abc", "assists": "2.9"},
        base | {"player_id": None, "season_name": "20/21"},
        base | {"player_id": "2", "season_name": None},
    )
    out = clean_table("player_performances", raw, audit=False).collect()
    assert len(out) == 2
    assert (out[0].season_name, out[0].goals, out[0].assists, out[0].competition_id) == ("20/21", 0, 2, "c")


def test_values_one_row_per_player_and_date(spark):
    raw = _all_text(
        spark,
        "player_market_value",
        {"player_id": "1", "date_unix": "2020-01-01", "value": "7"},
        {"player_id": "1", "date_unix": "2020-01-01", "value": "5"},
        {"player_id": "1", "date_unix": None, "value": "3000000000"},
        {"player_id": None, "date_unix": "2020-01-01", "value": "1"},
    )
    assert rows(clean_table("player_market_value", raw, audit=False), "value") == [(1, None, 0), (1, dt.date(2020, 1, 1), 5)]


def test_ids_are_numbers_before_duplicates_are_looked_for(spark):
    raw = _all_text(spark, "player_market_value", *({"player_id": i, "date_unix": d, "value": "7"} for i, d in (("01", "2020-01-01"), ("1", "2020-01-01"), ("x", "2020-01-01"), ("2", "soon"))))
    out = clean_table("player_market_value", raw, audit=False)
    assert rows(out, "player_id") == [(1, dt.date(2020, 1, 1), 7), (2, None, 7)]


def test_injuries_transfers_national_teammates(spark):
    raw = _all_text(spark, "player_injuries", {"player_id": "1", "season_name": " s", "injury_reason": "r ", "from_date": "2020-01-01", "end_date": "x", "days_missed": "-", "games_missed": "4"})
    assert rows(clean_table("player_injuries", raw, audit=False)) == [(1, "s", "r", dt.date(2020, 1, 1), None, 0, 4)]
    raw = _all_text(spark, "transfer_history", {"player_id": "1", "season_name": "20 ", "transfer_date": "2020-07-01", "from_team_id": "a ", "from_team_name": "A", "to_team_id": "b", "to_team_name": "B", "value_at_transfer": None, "transfer_fee": " free transfer "})
    assert rows(clean_table("transfer_history", raw, audit=False)) == [(1, "20", dt.date(2020, 7, 1), "a", "A", "b", "B", 0, "free transfer")]
    raw = _all_text(spark, "player_national_performances", {"player_id": "1", "team_id": " t", "debut": "2001-01-01", "matches": "x", "goals": "3.0"})
    assert rows(clean_table("player_national_performances", raw, audit=False)) == [(1, "t", dt.date(2001, 1, 1), 0, 3)]
    raw = _all_text(
        spark,
        "player_teammates_played_with",
        {"player_id": "1", "teammate_player_id": " 2", "teammate_player_name": "N ", "ppg_played_with": "?", "joint_goal_participation": "1", "minutes_played_with": "90.5"},
        {"player_id": "1", "teammate_player_id": None},
    )
    assert rows(clean_table("player_teammates_played_with", raw, audit=False)) == [(1, "2", "N", 0.0, 1, 90)]


def test_teams(spark):
    columns = "club_id club_slug club_name logo_url country_name season_id competition_id competition_slug competition_name club_division source_url".split()
    raw = _all_text(spark, "team_details", *({c: None for c in columns} | {"club_id": k, "club_name": n} for k, n in (("1", " x"), (" 1", "y"), ("1", " z"), (None, "n"))))
    out = clean_table("team_details", raw, audit=False).select("club_id", "club_name")
    assert rows(out, "club_name") == [("1", "x"), ("1", "y")]
    raw = _all_text(spark, "team_children", {"parent_team_id": " 1", "parent_team_name": "P", "child_team_id": "2 ", "child_team_name": None}, {"parent_team_id": None, "child_team_id": "3"})
    assert rows(clean_table("team_children", raw, audit=False)) == [("1", "P", "2", None)]


def test_team_seasons_pass_other_columns_through(spark):
    counts = "season_rank season_draws season_wins season_losses season_points season_goals_for season_goals_against season_goal_difference".split()
    texts = "club_id competition_id competition_name team_name season_season".split()
    raw = _all_text(spark, "t", {"extra": " e "} | {c: "x" for c in counts} | {c: None for c in texts})
    out = clean_table("team_competitions_seasons", raw)
    assert out.columns[:-1] == raw.columns and out.columns[-1] == "silver_processed_timestamp"
    record = one(out)
    assert record["extra"] == " e " and record["season_points"] == 0 and record["club_id"] is None


@pytest.mark.parametrize("table", sorted(SILVER))
def test_every_spec_has_unique_output_names(table):
    names = [r.name for r in SILVER[table].rules]
    assert len(names) == len(set(names))
