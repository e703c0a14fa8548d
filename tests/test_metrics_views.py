import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import one, rows
from statforge.plans import checks, metrics, views

PERF = "player_id int, goals int, assists int, nb_on_pitch int, minutes_played int, yellow_cards int, second_yellow_cards int, direct_red_cards int"


def test_form_metrics(spark):
    df = spark.createDataFrame([(1, 3, 1, 10, 60, 1, 1, 0), (1, 0, 2, 5, 60, 2, 0, 1), (2, 5, 0, 1, 89, 0, 0, 0)], PERF)
    out = {r.player_id: r for r in metrics.form_metrics(df, audit=False).collect()}
    r = out[1]
    assert (r.total_seasons, r.total_appearances, r.total_goals, r.total_assists, r.total_yellow_cards, r.total_red_cards) == (2, 15, 3, 3, 3, 2)
    assert (r.avg_goals_per_season, r.best_goals_season, r.best_assists_season, r.goal_contributions) == (1.5, 3, 2, 6)
    assert (r.goals_per_90min, r.assists_per_90min) == (2.25, 2.25)
    assert out[2].goals_per_90min is None
    assert metrics.form_metrics(df).columns[-1] == "gold_processed_timestamp"


def test_value_summary_and_timeline(spark):
    day = dt.date(2020, 1, 1)
    data = [(1, day, 5), (1, day + dt.timedelta(1), 0), (1, day + dt.timedelta(2), 4), (2, None, 7), (3, day, 3), (3, None, 9)]
    df = spark.createDataFrame(data, "player_id int, date_unix date, value int")
    out = {r.player_id: r for r in metrics.value_summary(df, audit=False).collect()}
    r = out[1]
    assert (r.peak_market_value, r.lowest_market_value, r.avg_market_value, r.value_records_count) == (5, 0, 3, 3)
    assert (r.latest_market_value, r.latest_valuation_timestamp, r.value_volatility) == (4, day + dt.timedelta(2), 5)
    assert (out[2].latest_market_value, out[2].latest_valuation_timestamp) == (7, None)
    assert out[3].latest_market_value == 3
    line = rows(metrics.value_timeline(df.where("player_id = 1")).select("value", "prev_value", "next_value", "value_change_pct", "trend_direction"), "date_unix")
    assert line == [(5, None, 0, 0.0, "STABLE"), (0, 5, 4, -100.0, "DECREASING"), (4, 0, None, 0.0, "INCREASING")]


def test_value_summary_tie_and_latest_row(spark):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(1, day, 5, 1), (1, day, 6, 2)], "player_id int, date_unix date, value int, seq int")
    assert one(metrics.value_summary(df, tie="seq"))["latest_market_value"] == 6
    assert one(metrics.latest_value(df))["value"] == 5


@pytest.mark.parametrize(
    ("n", "days", "score", "level"),
    [(1, 50, 0.1, "LOW"), (20, 1000, 2.0, "LOW"), (20, 1010, 2.01, "MEDIUM"), (50, 2500, 5.0, "MEDIUM"), (50, 2510, 5.01, "HIGH")],
)
def test_injury_levels(spark, n, days, score, level):
    df = spark.createDataFrame([(1, days if i == 0 else 0, 0) for i in range(n)], "player_id int, days_missed int, games_missed int")
    out = one(metrics.injury_risk(df))
    assert (out["injury_severity_score"], out["injury_risk_level"], out["longest_injury_days"]) == (score, level, days)


def test_transfer_intelligence(spark):
    data = [(1, None, 100, "free transfer"), (1, None, 50, "1000.75"), (1, None, 51, "-"), (2, None, 5, None), (3, None, 7, "7.9")]
    df = spark.createDataFrame(data, "player_id int, date date, value_at_transfer int, transfer_fee string")
    out = {r.player_id: r for r in metrics.transfer_intelligence(df, audit=False).collect()}
    r = out[1]
    assert (r.total_transfers, r.total_transfer_fees, r.avg_transfer_fee, r.highest_transfer_fee, r.avg_value_at_transfer) == (3, 1000, 1000, 1000, 67)
    assert (r.transfer_frequency, r.transfer_value_trend) == (0.3, "PROFIT")
    assert (out[2].total_transfer_fees, out[2].transfer_value_trend) == (None, "LOSS")
    # 7.9 is more than 7, but both are truncated before they are compared.
    assert out[3].transfer_value_trend == "LOSS"


SCORES = "goals_per_90min double, assists_per_90min double, peak_market_value bigint, injury_severity_score double"


@pytest.mark.parametrize(
    ("row", "scores"),
    [
        ((None, None, None, None), (0.0, 0.0, 100.0, 30.0)),
        ((1.5, 0.5, 100_000_000, 10.0), (100.0, 100.0, 0.0, 70.0)),
        ((1.51, 0.5, 100_000_001, 9.99), (100.0, 100.0, 0.1, 70.03)),
        ((0.25, 0.1, 1_234_567, 0.5), (17.5, 1.23, 95.0, 35.87)),
    ],
)
def test_scores(spark, row, scores):
    out = one(metrics.add_scores(spark.createDataFrame([row], SCORES)))
    assert tuple(out[c] for c in ("performance_score", "market_score", "health_score", "overall_player_score")) == scores


def make_profile(spark):
    people = [(i, None if i == 2 else f"P{i}", dt.date(2000, 1, 1), "GK", "X", "5" if i else "abc", 180, "LEFT") for i in range(4)]
    profiles = spark.createDataFrame(people, "player_id int, player_name string, date_of_birth date, position string, citizenship string, current_club_id string, height int, foot string")
    form = metrics.form_metrics(spark.createDataFrame([(2, 5, 5, 1, 90, 0, 0, 0), (1, 1, 0, 1, 90, 0, 0, 0)], PERF))
    values = metrics.value_summary(spark.createDataFrame([(1, dt.date(2020, 1, 1), 5)], "player_id int, date_unix date, value int"))
    injuries = metrics.injury_risk(spark.createDataFrame([(3, 1, 1)], "player_id int, days_missed int, games_missed int"))
    transfers = metrics.transfer_intelligence(spark.createDataFrame([(3, dt.date(2020, 1, 1), 5, "9")], "player_id int, date date, value_at_transfer int, transfer_fee string"))
    return profiles, form, values, injuries, transfers


def test_profile_360(spark):
    out = metrics.profile_360(*make_profile(spark), as_of="2024-06-30")
    assert len(out.columns) == 37 and out.columns[-1] == "gold_processed_timestamp"
    got = {r.player_id: r for r in out.collect()}
    # The best player has no name: ranked first, then dropped.
    assert set(got) == {0, 1, 3}
    assert got[1].player_rank == 2 and got[1].age == 24 and got[1].current_club_id == 5 and got[0].current_club_id is None
    assert got[0].overall_player_score == 30.0 and got[0].injury_risk_level is None and got[3].injury_risk_level == "LOW"
    assert {got[0].player_rank, got[3].player_rank} == {3, 4}
    assert (got[1].player_rank_percentile, got[1].total_goals, got[0].total_goals) == (0.33, 1, None)


def test_profile_is_independent_of_partitioning(spark):
    parts = make_profile(spark)
    plain = rows(metrics.profile_360(*parts, as_of="2024-06-30", audit=False), "player_id")
    shuffled = [p.repartition(5, F.rand(1)) for p in parts]
    assert rows(metrics.profile_360(*shuffled, as_of="2024-06-30", audit=False), "player_id") == plain


PROFILE = (
    "player_id int, player_name string, age int, player_main_position string, overall_player_score double, peak_market_value bigint, "
    "latest_market_value bigint, avg_market_value bigint, injury_risk_level string, total_goals bigint, total_assists bigint, "
    "goals_per_90min double, assists_per_90min double, injury_severity_score double, total_transfers bigint, total_injuries bigint, "
    "latest_valuation_timestamp date, performance_score double, market_score double, health_score double, player_rank bigint"
)


def person(i, **kw):
    base = dict.fromkeys(c.split()[0] for c in PROFILE.split(", ")) | {
        "player_id": i,
        "age": 25,
        "player_main_position": "GK",
        "overall_player_score": 60.0,
        "peak_market_value": 20_000_000,
        "latest_market_value": 10,
        "avg_market_value": 4,
        "injury_risk_level": "LOW",
    }
    return tuple((base | kw).values())


def test_top_players(spark):
    df = spark.createDataFrame([person(1, overall_player_score=0.0), person(2, overall_player_score=None), person(4), person(3)], PROFILE)
    assert [r.player_id for r in views.top_players(df).collect()] == [3, 4]
    assert [r.player_id for r in views.top_players(df, 1).collect()] == [3]


def test_high_value_low_risk_excludes_unknown_risk(spark):
    people = [person(1), person(2, injury_risk_level=None), person(3, peak_market_value=10_000_000), person(4, age=31), person(5, age=30, peak_market_value=30_000_000), person(6, age=20), person(7, injury_risk_level="HIGH")]
    assert [r.player_id for r in views.high_value_low_risk(spark.createDataFrame(people, PROFILE)).collect()] == [5, 1, 6]


def test_transfer_opportunities(spark):
    ages = {1: 20, 2: 22, 3: 26, 4: 27, 5: 29, 6: 24, 7: 24, 8: 24}
    people = [person(i, age=a) for i, a in ages.items()]
    people[5] = person(6, age=24, injury_risk_level="MEDIUM", overall_player_score=100.0)
    people[6] = person(7, age=24, latest_market_value=0)
    trend = "player_id int, transfer_value_trend string, total_transfers bigint, avg_transfer_fee bigint"
    deals = spark.createDataFrame([(i, "LOSS" if i == 8 else "PROFIT", 1, 2) for i in ages], trend)
    out = {r.player_id: r for r in views.transfer_opportunities(spark.createDataFrame(people, PROFILE), deals).collect()}
    assert {i: r.opportunity_score for i, r in out.items()} == {1: 79.0, 2: 84.0, 3: 84.0, 4: 79.0, 6: 90.0}
    assert out[1].value_growth == 6
    ordered = views.transfer_opportunities(spark.createDataFrame(people, PROFILE), deals)
    assert [r.player_id for r in ordered.collect()] == [6, 2, 3, 1, 4]
    assert [r.player_id for r in views.young_opportunities(ordered, below_age=25).collect()] == [6, 1, 2]


def test_opportunity_is_clamped(spark):
    df = spark.createDataFrame([(300.0, "PROFIT", "LOW", 24, 5), (60.0, "LOSS", None, 40, 5), (60.0, "LOSS", "LOW", 24, 0)], "overall_player_score double, transfer_value_trend string, injury_risk_level string, age int, latest_market_value int")
    assert [r[0] for r in df.select(views.opportunity_score()).collect()] == [100.0, 29.0, 0.0]


def test_group_views(spark):
    ages = [20, 21, 25, 26, 30, 31, 35, 36, None]
    df = spark.createDataFrame([person(i, age=a, injury_risk_level="HIGH" if i == 0 else "LOW") for i, a in enumerate(ages)] + [person(99, player_main_position=None)], PROFILE)
    groups = {r.age_group: r.total_players for r in views.age_group_analysis(df).collect()}
    assert groups == {"U21": 1, "21-25": 3, "26-30": 2, "31-35": 2, "35+": 1}
    assert [r[0] for r in df.where("age is null").select(views.age_group()).collect()] == ["Unknown"]
    stats = one(views.position_statistics(df))
    assert (stats["total_players"], stats["high_risk_count"], stats["medium_risk_count"], stats["low_risk_count"]) == (9, 1, 0, 8)
    assert views.positions_by_size(views.position_statistics(df)).count() == 1


STANDING = "competition_id int, competition_name string, competition_code string, season_id int, stage string, standing_type string, group_name string, team_id int, team_name string, team_tla string, team_crest_url string, position int, played_games int, won int, draw int, lost int, points int, goals_for int, goals_against int, goal_difference int, form string, current_matchday int, area_name string, season_end_date date"


def standing(comp, season, kind, team, position=1, played=2, points=3, gf=2, ga=1, group=None):
    return (comp, f"C{comp}", f"K{comp}", season, "R", kind, group, team, f"T{team}", "T", None, position, played, 1, 0, 1, points, gf, ga, gf - ga, "W", 1, "old", None)


COMPETITION = "competition_id int, competition_name string, competition_code string, competition_type string, area_name string, current_season_id int, current_matchday int, season_start_date date, season_end_date date"


def standings_fixture(spark):
    table = spark.createDataFrame(
        [
            standing(1, 2024, "TOTAL", 1),
            standing(1, 2024, "TOTAL", 2, position=2, played=0, points=0),
            standing(1, 2024, "TOTAL", 3, position=6, points=3),
            standing(1, 2023, "TOTAL", 1, points=99),
            standing(1, 2024, "HOME", 1, points=3),
            standing(1, 2024, "AWAY", 1, points=1),
            standing(1, 2024, "HOME", 2, points=3),
        ],
        STANDING,
    )
    comps = spark.createDataFrame([(1, "C1", "K1", "LEAGUE", "new", 2024, 30, None, dt.date(2024, 12, 31)), (2, "C2", "K2", "CUP", "new", 2024, 1, None, None)], COMPETITION)
    return table, comps


def test_standings_views(spark):
    table, comps = standings_fixture(spark)
    current = views.current_standings(table, comps)
    assert rows(current.select("position", "team_name", "current_matchday", "season_end_date")) == [(1, "T1", 30, dt.date(2024, 12, 31)), (2, "T2", 30, dt.date(2024, 12, 31)), (6, "T3", 30, dt.date(2024, 12, 31))]
    assert rows(views.top_teams(table, comps).select("team_name", "points_per_game", "goals_per_game")) == [("T1", 1.5, 1.0), ("T2", None, None)]
    summary = rows(views.competition_summary(table, comps).select("competition_id", "total_teams", "total_goals", "avg_goals_per_game", "max_points", "min_points"))
    assert summary == [(1, 3, 6, 2.25, 3, 0), (2, 0, None, None, None, None)]
    assert rows(views.home_away(table, comps).select("team_name", "total_points", "home_advantage", "performance_type")) == [("T1", 4, 2, "Stronger at home")]
    ranked = rows(views.competition_rankings(table, comps).select("team_id", "overall_rank", "win_percentage", "area_name"), "team_id")
    assert ranked == [(1, 1, 50.0, "new"), (2, 3, None, "new"), (3, 1, 50.0, "new")]
    assert [r.team_name for r in views.standings_of(table, "K1", "R").where("season_id = 2024").collect()] == ["T1", "T2", "T3"]
    assert views.best_by_points(table, 1).first().points == 99
    assert set(views.build_standing_views(table, comps)) >= {"vw_current_standings", "mv_competition_rankings"}


def test_live_views(spark):
    at = dt.datetime(2024, 1, 1, 12)
    columns = "match_id int, event_timestamp timestamp, status string, minute int, competition_name string, competition_code string, home_team_name string, away_team_name string, home_score int, away_score int, total_goals int, match_result string, venue string, is_live boolean"
    events = spark.createDataFrame(
        [
            (1, at, "IN_PLAY", 1, "C", "c", "A", "B", 0, 0, 0, "DRAW", "v", True),
            (1, at + dt.timedelta(minutes=5), "IN_PLAY", 6, "C", "c", "A", "B", 1, None, 1, "HOME", "v", True),
            (1, at + dt.timedelta(minutes=9), "FINISHED", 9, "C", "c", "A", "B", 2, 3, 5, "AWAY", "v", False),
            (2, at, "IN_PLAY", 1, "C", "c", "D", "E", 1, 2, 3, "AWAY", "v", True),
        ],
        columns,
    )
    live = rows(views.current_live(events).select("match_id", "match_summary", "leading_team"))
    assert live == [(1, "A 1-0 B", "DRAW"), (2, "D 1-2 E", "E")]
    assert [r.minute for r in views.score_progression(events).collect()] == [1, 6, 9, 1]
    assert rows(views.competition_live_summary(events)) == [("C", "c", 2, 9, 2.25, 5, 3)]
    assert views.recent_events(events, "2024-01-01 12:30:00", "26 minutes").count() == 2
    assert views.recent_events(events).count() == 0
    assert set(views.register_all(spark, views.build_live_views(events))) == {"vw_current_live_matches", "vw_match_score_progression", "mvw_competition_summary"}
    assert spark.sql("select count(*) from vw_current_live_matches").first()[0] == 2


def test_serving_types(spark):
    df = metrics.add_scores(spark.createDataFrame([(1.23456, 0.5, 5, 2.0)], SCORES))
    typed = checks.serving_types(df)
    assert dict(typed.dtypes)["goals_per_90min"] == "decimal(10,4)" and dict(typed.dtypes)["performance_score"] == "decimal(10,2)"


def test_row_counts_and_scorers(spark):
    assert rows(views.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    people = spark.createDataFrame([person(1), person(2), person(3)], PROFILE)
    form = spark.createDataFrame([(1, 51, 0.5), (2, 50, 0.9), (3, 60, None)], "player_id int, total_goals bigint, goals_per_90min double")
    risk = spark.createDataFrame([(1, "LOW"), (2, "LOW"), (3, "LOW")], "player_id int, injury_risk_level string")
    value = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "player_id int, peak_market_value bigint")
    assert [r.player_id for r in views.reliable_scorers(people, form, risk, value).collect()] == [1, 3]


def test_value_change_takes_the_last_value_at_or_before_each_day(spark):
    data = [
        (1, "2019-01-01", 10), (1, "2021-06-01", 50), (1, "2022-05-31", 60), (1, "2024-06-30", 90), (1, "2024-07-01", 5),
        (2, "2023-12-01", 7), (3, "2024-12-01", 8), (4, None, 9), (5, "2020-01-01", 4),
    ]
    df = spark.createDataFrame(data, "player_id bigint, date_unix string, value int").withColumn("date_unix", F.col("date_unix").cast("date"))
    found = {r[0]: r[1:] for r in map(tuple, metrics.value_change(df, "2024-06-30", audit=False).collect())}
    assert found == {1: (90, 60, 50, 30, 40), 2: (7, None, None, None, None), 5: (4, 4, 4, 0, 0)}
    plan = metrics.value_change(df, "2024-06-30", audit=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_recent_form_sums_the_last_seasons(spark):
    data = [(1, s, g, a, m) for s, g, a, m in [("2024", 1, 0, 90), ("2024", 2, 1, 90), ("2023", 4, 0, 900), ("2022", 8, 0, 10), ("2021", 100, 0, 10), (None, 100, 0, 10)]]
    data += [(2, "2020", 0, 0, 0)]
    df = spark.createDataFrame(data, "player_id bigint, season_name string, goals int, assists int, minutes_played int")
    found = {r.player_id: r for r in metrics.recent_form(df, audit=False).collect()}
    one_ = found[1]
    assert (one_.last_season, one_.last_season_goals, one_.last_season_assists, one_.last_season_minutes, one_.last_season_goal_participation) == ("2024", 3, 1, 180, 4)
    assert (one_.seasons_counted, one_.last_3_seasons_goals, one_.last_3_seasons_minutes) == (3, 15, 1090)
    assert one_.last_season_goals_per_90 == 1.5 and found[2].last_season_goals_per_90 is None
