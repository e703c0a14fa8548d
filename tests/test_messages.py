import datetime as dt
import json

from conftest import one, rows
from statforge.functions import messages as M
from statforge.plans import bindings as B
from statforge.plans import views
from statforge.plans.queries import FILE_MESSAGES, write_message_files
from statforge.sources.files import competitions_file, standings_dir
from statforge.streaming.jobs import load_standings_files


def batch(spark, *messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


MATCH = {
    "id": 7,
    "utcDate": "2024-01-01T20:00:00Z",
    "status": "IN_PLAY",
    "area": {"id": 1, "name": "Europe"},
    "season": {"id": "9", "startDate": "2024-01-01", "winner": {"id": 3, "name": "A"}},
    "homeTeam": {"id": 10, "name": "H", "crest": "http://x"},
    "score": {"fullTime": {"home": 2}},
    "referees": [{"id": 1}],
}


def test_match(spark):
    parsed = M.parse(batch(spark, MATCH), M.MATCH)
    out = one(M.flatten_match(parsed))
    assert (out["match_id"], out["utc_date"]) == (7, dt.datetime(2024, 1, 2, 3))
    assert (out["matchday"], out["stage"], out["winner"], out["duration"]) == (0, "UNKNOWN", "DRAW", "REGULAR")
    assert (out["ft_home_goals"], out["ft_away_goals"], out["ht_home_goals"]) == (2, 0, 0)
    assert (out["season_id"], out["season_start_date"], out["season_end_date"]) == (9, dt.date(2024, 1, 1), None)
    assert (out["home_team_id"], out["away_team_id"], out["area_code"], out["competition_details"]) == (10, None, None, None)
    assert json.loads(out["season_details"])["winner"] == '{"id":3,"name":"A"}'
    assert json.loads(out["raw"]) == MATCH and json.loads(out["referees"]) == [{"id": "1"}]
    assert len(out) == 38
    assert one(M.flatten_match(parsed, zone=None))["utc_date"] == dt.datetime(2024, 1, 1, 20)


def test_broken_matches_are_dropped_and_countable(spark):
    bad = ["{not json", json.dumps(MATCH | {"status": None}), json.dumps(MATCH | {"utcDate": "yesterday"}), json.dumps(MATCH | {"id": "x"}), "[]"]
    parsed = M.parse(batch(spark, MATCH, *bad), M.MATCH)
    assert M.flatten_match(parsed).count() == 1
    assert "{not json" in [r[0] for r in M.unreadable(parsed).collect()]
    assert M.parse(spark.createDataFrame([(None,)], "value string"), M.MATCH).count() == 1


def test_message_is_parsed_once(spark):
    flat = M.flatten_match(M.parse(batch(spark, MATCH), M.MATCH))
    plan = flat._jdf.queryExecution().executedPlan().toString().lower()
    assert plan.count("from_json") == 1 and "generate" in plan


def test_match_views(spark):
    flat = M.flatten_match(M.parse(batch(spark, MATCH, MATCH | {"id": 8, "status": "FINISHED", "score": {"winner": "HOME_TEAM"}}), M.MATCH))
    assert rows(views.live_lines(flat).select("match_id", "match")) == [(7, None)]
    assert rows(views.home_wins(flat)) == [("H", 2, 1)]
    assert [r.match_id for r in views.home_matches(flat, "H").collect()] == [8]
    assert rows(views.team_logos(flat).select("logo_url")) == [("http://x",), ("http://x",)]


COMPETITION = {"id": 1, "name": "League", "code": "L", "area": {"id": 2, "name": "E"}, "currentSeason": {"id": 3, "startDate": "2024-01-01", "winner": None}, "lastUpdated": "2024-01-01T00:00:00Z"}


def test_competition(spark):
    parsed = M.parse(batch(spark, COMPETITION, COMPETITION | {"name": None}, {"id": 5, "name": "bare"}), M.COMPETITION)
    out = {r.competition_id: r for r in M.flatten_competition(parsed).collect()}
    assert set(out) == {1, 5}
    assert (out[1].current_season_id, out[1].season_winner_id, out[1].current_matchday, out[1].number_of_available_seasons) == (3, None, 0, 0)
    assert out[1].last_updated == dt.datetime(2024, 1, 1) and out[5].area_id is None


def team(ident, **kw):
    return {"position": 1, "team": {"id": ident, "name": f"T{ident}"}} | kw


def message(*standings, **kw):
    return {"competition": {"id": 1, "name": "L", "code": "L"}, "season": {"id": 2, "startDate": "2024-01-01"}, "area": {"id": 3}, "standings": list(standings)} | kw


def test_standings(spark):
    good = message(
        {"stage": "S", "type": "HOME", "group": "G", "table": [team(1, points=3, won=1), team(None)]},
        {"table": [team(2)]},
        {"type": "AWAY", "table": []},
        {"type": "AWAY"},
    )
    dropped = [message(), message(season={"id": None}), {"competition": {"id": 1}}, "oops"]
    out = M.flatten_standings(M.parse(batch(spark, good, *dropped), M.STANDINGS))
    got = rows(out.select("stage", "standing_type", "group_name", "team_id", "points", "played_games", "current_matchday"), "team_id")
    assert got == [("S", "HOME", "G", 1, 3, 0, 0), ("REGULAR_SEASON", "TOTAL", None, 2, 0, 0, 0)]


def test_competitions_file(spark, folder):
    with open(f"{folder}/c.json", "w") as f:
        json.dump({"competitions": [COMPETITION, COMPETITION | {"id": 2, "currentSeason": {"id": 4, "winner": {"id": 9, "name": "W"}}}]}, f, indent=1)
    assert rows(competitions_file(spark, f"{folder}/c.json").select("competition_id", "season_winner_name"), "competition_id") == [(1, None), (2, "W")]


def test_more_competition_messages_make_more_files(spark, folder):
    """Equal messages too: no file and no group holds more than the limit, and all are read."""
    sent = spark.range(0, 20500, 1, 3).selectExpr("if(id < 9000, 7, id) AS id").selectExpr("to_json(struct(id, 'L' AS name)) AS value")
    write_message_files(sent, f"{folder}/many")
    held = spark.read.text(f"{folder}/many", wholetext=True).selectExpr("size(split(value, '\"id\"')) - 1 AS n")
    assert sum(n for (n,) in held.collect()) == 20500
    assert held.agg({"n": "max"}).first()[0] <= FILE_MESSAGES
    found = competitions_file(spark, f"{folder}/many")
    assert (found.count(), found.where("competition_id = 7").count(), found.select("competition_id").distinct().count()) == (20500, 9000, 11501)
    write_message_files(sent.where("false"), f"{folder}/none")
    assert competitions_file(spark, f"{folder}/none").count() == 0


def test_standings_files_update_some_columns_in_name_order(spark, folder):
    first = message({"stage": "S", "type": "TOTAL", "table": [team(1, points=1), team(2, points=5), team(None)]})
    second = message({"stage": "S", "type": "TOTAL", "table": [team(1, points=2)]}, competition={"id": 1, "name": "Renamed"})
    for name, content in (("b.json", second), ("a.json", first)):
        with open(f"{folder}/{name}", "w") as f:
            json.dump(content, f, indent=2)
    files = standings_dir(spark, folder)
    assert files.where("current_matchday is null").count() == 3
    loaded = load_standings_files(None, files, "bronze_source_file")
    assert rows(loaded.select("team_id", "points", "competition_name"), "team_id") == [(1, 2, "L"), (2, 5, "L")]
    state = loaded.withColumn("points", loaded.points + 100)
    again = load_standings_files(state, files, "bronze_source_file")
    assert rows(again.select("team_id", "points", "competition_name"), "team_id") == [(1, 2, "L"), (2, 5, "L")]


def test_standings_files_tell_null_from_absent(spark, folder):
    row = {"position": 1, "team": {"id": 5, "name": "T"}, "points": None, "won": 3}
    with open(f"{folder}/a.json", "w") as out:
        json.dump({"competition": {"id": 1}, "season": {"id": 2}, "standings": [{"table": [row]}]}, out, indent=1)
    found = one(standings_dir(spark, folder))
    assert (found["points"], found["won"], found["draw"], found["team_name"]) == (None, 3, 0, "T")


def test_messages_are_dealt_over_all_tasks_of_the_session(spark, folder):
    """Short rows become long text: tasks merged by the rows' size would leave cores without work."""
    lines = spark.range(0, 400, 1, 1).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "5D AS l_quantity", "'R' AS l_returnflag", "'F' AS l_linestatus"
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")
    messages = B.standings_messages(B.Tables(spark, folder))
    assert messages.rdd.getNumPartitions() == 4
    assert messages.count() == 400
