"""The registered queries in SQL, for an independent engine on the same Parquet tables.

Written from the rules, not from the Spark plans: ordinary window functions and joins, no histograms,
no salting. ``WITH`` fragments mirror ``bindings.py``.
"""

from __future__ import annotations

import re

from statforge.plans.checks import declared

CTES: dict[str, str] = {}


def _r(x: str, digits: int) -> str:
    """Round half up on the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _int(x: str) -> str:
    """Lenient integer of text, 0 if unreadable."""
    return (
        f"COALESCE(CASE WHEN TRY_CAST({x} AS DOUBLE) IS NOT NULL "
        f"THEN TRY_CAST(split_part(trim({x}), '.', 1) AS INTEGER) END, 0)"
    )


def _ints(*names: str) -> str:
    return ", ".join(f"CAST({_int(n)} AS BIGINT) AS {n}" for n in names)


def _trims(*names: str) -> str:
    return ", ".join(f"trim({n}) AS {n}" for n in names)


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


CTES["raw_profiles"] = """
  SELECT c_custkey AS player_id,
    CASE WHEN c_custkey % 194 <> 5 THEN ' slug-' || c_custkey || '-' || copy || ' ' END AS player_slug,
    CASE WHEN c_custkey % 97 <> 5 THEN '  ' || c_name END AS player_name,
    CASE WHEN c_custkey % 50 = 0 THEN '2020-13-01'
         ELSE CAST(DATE '1985-01-01' + CAST(c_custkey * 37 % 7000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
    CASE WHEN c_custkey % 7 <> 0 THEN n_name || ' ' END AS place_of_birth,
    CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE n_name END AS country_of_birth,
    CASE c_custkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '1.' || (50 + c_custkey % 50) ELSE '' || (150 + c_custkey % 60) END AS height,
    n_name AS citizenship,
    CASE WHEN c_custkey % 41 <> 0 THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) END AS position,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN ' left' ELSE 'Right ' END AS foot,
    CAST(c_nationkey AS VARCHAR) AS current_club_id,
    CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE '2026-06-30' END AS contract_expires,
    c_mktsegment AS main_position
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  CROSS JOIN (VALUES ('a'), ('b')) AS copies(copy)
  WHERE copy = 'a' OR c_custkey % 8 = 0"""
CTES["profiles"] = f"""
  SELECT player_id, trim(player_slug) AS player_slug, COALESCE(trim(player_name), trim(player_slug)) AS player_name,
    TRY_CAST(date_of_birth AS DATE) AS date_of_birth, COALESCE(trim(place_of_birth), 'Unknown') AS place_of_birth,
    COALESCE(trim(country_of_birth), 'Unknown') AS country_of_birth,
    CASE WHEN CAST(height AS DOUBLE) = 0 THEN NULL
         WHEN CAST(height AS DOUBLE) < 10 THEN CAST(trunc(CAST(height AS DOUBLE) * 100) AS BIGINT)
         ELSE CAST(trunc(CAST(height AS DOUBLE)) AS BIGINT) END AS height,
    citizenship, COALESCE(trim(citizenship), 'Unknown') AS citizenship_country,
    COALESCE(trim(position), 'Unknown') AS position, COALESCE(upper(trim(foot)), 'UNKNOWN') AS foot,
    trim(current_club_id) AS current_club_id, TRY_CAST(contract_expires AS DATE) AS contract_expires,
    trim(main_position) AS player_main_position
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY player_slug NULLS LAST) AS rn FROM raw_profiles)
  WHERE rn = 1"""
CTES["raw_performances"] = """
  SELECT CASE WHEN l_partkey % 501 <> 500 THEN o_custkey END AS player_id,
    ' ' || year(o_orderdate) AS season_name, o_orderpriority AS competition_id,
    o_orderpriority || '  ' AS competition_name, '' || l_suppkey AS team_id, '' AS team_name, '1' AS nb_in_group,
    CASE WHEN l_linenumber <> 6 THEN '1.0' END AS nb_on_pitch,
    CASE l_linenumber WHEN 7 THEN 'n/a' WHEN 1 THEN '1' ELSE '0' END AS goals,
    CASE WHEN l_discount >= 0.08 THEN '1' ELSE '0' END AS assists,
    CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS yellow_cards,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1' ELSE '0' END AS second_yellow_cards,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '1' ELSE '0' END AS direct_red_cards,
    CASE WHEN l_linenumber = 1 AND l_tax > 0.05 THEN '1' ELSE '0' END AS penalty_goals,
    (CAST(trunc(l_quantity) AS BIGINT) * (1 + o_custkey % 4)) || '.5' AS minutes_played,
    CASE WHEN l_linenumber = 3 THEN '3000000000' ELSE '4' END AS goals_conceded, ' 2 ' AS clean_sheets
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTES["performances"] = f"""
  SELECT player_id, {_trims('season_name', 'competition_id', 'competition_name', 'team_id', 'team_name')},
    {_ints('nb_in_group', 'nb_on_pitch', 'goals')}, CAST(0 AS BIGINT) AS own_goals, {_ints('assists')},
    CAST(0 AS BIGINT) AS subed_in, CAST(0 AS BIGINT) AS subed_out,
    {_ints('yellow_cards', 'second_yellow_cards', 'direct_red_cards', 'penalty_goals', 'minutes_played', 'goals_conceded', 'clean_sheets')}
  FROM raw_performances WHERE player_id IS NOT NULL AND season_name IS NOT NULL"""
CTES["raw_values"] = """
  SELECT o_custkey AS player_id, CAST(o_orderdate AS DATE) AS date_unix,
    CAST(CAST(floor(o_totalprice * 25 * (o_custkey % 10 + 1)) AS BIGINT) AS VARCHAR) AS value
  FROM orders"""
CTES["values_"] = f"""
  SELECT player_id, date_unix, {_ints('value')}
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id, date_unix ORDER BY value) AS rn FROM raw_values)
  WHERE rn = 1"""
CTES["raw_latest_values"] = """
  SELECT o_custkey AS player_id, CAST(arg_max(CAST(floor(o_totalprice * 25 * (o_custkey % 10 + 1)) AS BIGINT), o_orderkey) AS VARCHAR) AS latest_market_value,
    max(CAST(o_orderdate AS DATE)) AS value_date FROM orders GROUP BY o_custkey"""
CTES["raw_injuries"] = """
  SELECT user_id AS player_id, '23/24 ' AS season_name, ' ' || json_extract_string(props, '$.k') AS injury_reason,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS from_date,
    CASE WHEN event_id % 10 = 0 THEN 'unknown'
         ELSE CAST(CAST(ts AS DATE) + CAST(event_id % 30 - 2 AS INTEGER) AS VARCHAR) END AS end_date,
    CAST(CAST(floor(value * (1 + user_id % 6)) AS BIGINT) AS VARCHAR) AS days_missed,
    CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(CAST(floor(value / 7) AS BIGINT) AS VARCHAR) END AS games_missed
  FROM events WHERE event_type = 'error'"""
CTES["injuries"] = f"""
  SELECT player_id, {_trims('season_name', 'injury_reason')}, TRY_CAST(from_date AS DATE) AS from_date,
    TRY_CAST(end_date AS DATE) AS end_date, {_ints('days_missed', 'games_missed')}
  FROM raw_injuries"""
CTES["raw_transfers"] = """
  SELECT o_custkey AS player_id, year(o_orderdate) || ' ' AS season_name,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS transfer_date,
    '' || (o_orderkey % 20) AS from_team_id, ' A' AS from_team_name, '' || (o_custkey % 20) AS to_team_id, 'B ' AS to_team_name,
    CAST(CAST(floor(o_totalprice * 1.2::DOUBLE) AS BIGINT) AS VARCHAR) AS value_at_transfer,
    CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) WHEN 'P' THEN ' free transfer' END AS transfer_fee
  FROM orders"""
CTES["transfers"] = f"""
  SELECT player_id, trim(season_name) AS season, TRY_CAST(transfer_date AS DATE) AS date,
    {_trims('from_team_id', 'from_team_name', 'to_team_id', 'to_team_name')}, {_ints('value_at_transfer')},
    trim(transfer_fee) AS transfer_fee
  FROM raw_transfers"""


def _per90(x: str, minutes: str = "total_minutes_played") -> str:
    return _r(f"CASE WHEN {minutes} >= 90 THEN least({x} / ({minutes} / 90), 3.0::DOUBLE) END", 4)


CTES["form"] = f"""
  SELECT *, {_per90('total_goals')} AS goals_per_90min, {_per90('total_assists')} AS assists_per_90min,
    total_goals + total_assists AS goal_contributions
  FROM (SELECT player_id, count(*) AS total_seasons, CAST(sum(nb_on_pitch) AS BIGINT) AS total_appearances,
      CAST(sum(goals) AS BIGINT) AS total_goals, CAST(sum(assists) AS BIGINT) AS total_assists,
      CAST(sum(yellow_cards) AS BIGINT) AS total_yellow_cards,
      CAST(sum(second_yellow_cards) + sum(direct_red_cards) AS BIGINT) AS total_red_cards,
      CAST(sum(minutes_played) AS BIGINT) AS total_minutes_played, {_r('avg(goals)', 2)} AS avg_goals_per_season,
      {_r('avg(assists)', 2)} AS avg_assists_per_season, max(goals) AS best_goals_season, max(assists) AS best_assists_season
    FROM performances GROUP BY player_id)"""
CTES["value_trends"] = """
  SELECT *, peak_market_value - lowest_market_value AS value_volatility
  FROM (SELECT player_id, max(value) AS peak_market_value, min(value) AS lowest_market_value,
      CAST(trunc(avg(value)) AS BIGINT) AS avg_market_value, count(*) AS value_records_count,
      arg_max(value, date_unix) AS latest_market_value, max(date_unix) AS latest_valuation_timestamp
    FROM values_ GROUP BY player_id)"""
CTES["risk"] = f"""
  SELECT *, CASE WHEN injury_severity_score > 5 THEN 'HIGH' WHEN injury_severity_score > 2 THEN 'MEDIUM' ELSE 'LOW' END AS injury_risk_level
  FROM (SELECT player_id, count(*) AS total_injuries, CAST(sum(days_missed) AS BIGINT) AS total_days_missed,
      CAST(sum(games_missed) AS BIGINT) AS total_games_missed, {_r('avg(days_missed)', 2)} AS avg_days_per_injury,
      {_r('avg(games_missed)', 2)} AS avg_games_per_injury, max(days_missed) AS longest_injury_days,
      max(games_missed) AS longest_injury_games,
      {_r('(count(*) * 5 + sum(days_missed) / 10) / 100', 2)} AS injury_severity_score
    FROM injuries GROUP BY player_id)"""
CTES["deals"] = f"""
  SELECT *, {_r('total_transfers / 10', 2)} AS transfer_frequency,
    CASE WHEN total_transfer_fees > avg_value_at_transfer THEN 'PROFIT' ELSE 'LOSS' END AS transfer_value_trend
  FROM (SELECT player_id, count(*) AS total_transfers, CAST(floor(sum(fee)) AS BIGINT) AS total_transfer_fees,
      CAST(CAST(sum(fee) * 100 AS HUGEINT) // (count(fee) * 100) AS BIGINT) AS avg_transfer_fee,
      CAST(floor(max(fee)) AS BIGINT) AS highest_transfer_fee,
      CAST(trunc(avg(value_at_transfer)) AS BIGINT) AS avg_value_at_transfer, max(date) AS last_transfer_date
    FROM (SELECT *, TRY_CAST(transfer_fee AS DECIMAL(28,2)) AS fee FROM transfers) GROUP BY player_id)"""
CTES["scored"] = f"""
  SELECT *, {_r('performance_score * 0.4::DOUBLE + market_score * 0.3::DOUBLE + health_score * 0.3::DOUBLE', 2)} AS overall_player_score
  FROM (SELECT *,
      COALESCE({_r("CASE WHEN goals_per_90min + assists_per_90min > 2.0 THEN 100.0::DOUBLE ELSE (goals_per_90min + assists_per_90min) * 50 END", 2)}, 0) AS performance_score,
      COALESCE({_r("CASE WHEN peak_market_value > 100000000 THEN 100.0::DOUBLE ELSE peak_market_value / 1000000.0::DOUBLE END", 2)}, 0) AS market_score,
      COALESCE({_r("CASE WHEN injury_severity_score >= 10 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE - injury_severity_score * 10 END", 2)}, 100) AS health_score,
      2024 - year(date_of_birth) AS age
    FROM profiles LEFT JOIN form USING (player_id) LEFT JOIN value_trends USING (player_id)
      LEFT JOIN risk USING (player_id) LEFT JOIN deals USING (player_id))"""
CTES["profile"] = f"""
  SELECT player_id, player_name, date_of_birth, age, position AS player_main_position, citizenship,
    CAST(current_club_id AS BIGINT) AS current_club_id, height, foot, total_appearances, total_goals, total_assists,
    goals_per_90min, assists_per_90min, goal_contributions, avg_goals_per_season, avg_assists_per_season,
    peak_market_value, latest_market_value, avg_market_value, value_volatility, latest_valuation_timestamp,
    total_injuries, total_days_missed, injury_severity_score, injury_risk_level, total_transfers, total_transfer_fees,
    avg_transfer_fee, last_transfer_date, performance_score, market_score, health_score, overall_player_score,
    player_rank, player_rank_percentile
  FROM (SELECT *,
      row_number() OVER (ORDER BY overall_player_score DESC, md5(CAST(player_id AS VARCHAR))) AS player_rank,
      {_r('percent_rank() OVER (ORDER BY overall_player_score DESC)', 2)} AS player_rank_percentile FROM scored)
  WHERE player_name IS NOT NULL"""
CTES["opportunities"] = """
  SELECT player_id, player_name, age, player_main_position, peak_market_value, latest_market_value,
    CAST(latest_valuation_timestamp AS VARCHAR) AS latest_valuation_timestamp, avg_market_value,
    latest_market_value - avg_market_value AS value_growth, total_goals, goals_per_90min, d.total_transfers,
    d.avg_transfer_fee, d.transfer_value_trend, injury_risk_level, overall_player_score,
    least(100, greatest(0, overall_player_score * 0.4::DOUBLE + 20
      + CASE injury_risk_level WHEN 'LOW' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END
      + CASE WHEN age BETWEEN 22 AND 26 THEN 20 WHEN age BETWEEN 20 AND 28 THEN 15 ELSE 5 END)) AS opportunity_score
  FROM profile p JOIN deals d USING (player_id)
  WHERE age BETWEEN 20 AND 28 AND injury_risk_level IN ('LOW', 'MEDIUM') AND d.transfer_value_trend = 'PROFIT'
    AND overall_player_score > 50 AND latest_market_value > 0"""
CTES["safe"] = """
  SELECT player_id, player_name, age, player_main_position, peak_market_value, latest_market_value,
    CAST(latest_valuation_timestamp AS VARCHAR) AS latest_valuation_timestamp, avg_market_value, injury_risk_level,
    total_injuries, total_goals, total_assists, overall_player_score
  FROM profile WHERE peak_market_value > 10000000 AND injury_risk_level = 'LOW' AND age BETWEEN 20 AND 30"""


def _avg4(c: str) -> str:
    """Exact average of non-negative values with at most six decimals, rounded half up to four."""
    total = f"sum(CAST(round(CAST({c} AS DOUBLE) * 1000000) AS HUGEINT))"
    return f"CAST(({total} * 20000 + count({c}) * 1000000) // (2 * count({c}) * 1000000) AS DOUBLE) / 10000"


_COMMON = ", ".join(
    f"{_avg4(c)} AS {n}"
    for n, c in (
        ("avg_overall_score", "overall_player_score"),
        ("avg_peak_market_value", "peak_market_value"),
        ("avg_latest_market_value", "latest_market_value"),
        ("avg_market_value", "avg_market_value"),
        ("avg_goals", "total_goals"),
        ("avg_assists", "total_assists"),
    )
)
CTES["raw_teams"] = """
  SELECT CASE WHEN pad = 1 THEN ' ' ELSE '' END || s_suppkey AS club_id, CASE WHEN s_suppkey % 3 <> 0 THEN ' First' END AS club_division
  FROM supplier CROSS JOIN (VALUES (0), (1)) AS pads(pad) WHERE pad = 0 OR s_suppkey % 5 = 0"""
CTES["raw_national"] = """
  SELECT CASE WHEN o_orderkey % 100 <> 3 THEN o_custkey END AS player_id,
    CASE WHEN o_orderkey % 4 = 0 THEN '03/05/2001' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS debut,
    '' || (o_orderkey % 90) AS matches, CASE WHEN o_orderkey % 6 = 0 THEN 'none' ELSE '' || (o_orderkey % 30) END AS goals FROM orders"""
CTES["raw_teammates"] = """
  SELECT o_custkey AS player_id, CASE WHEN l_suppkey % 50 <> 7 THEN ' ' || l_suppkey END AS teammate_player_id,
    CASE WHEN l_linenumber = 2 THEN '?' ELSE CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR) END AS ppg_played_with,
    '' || l_linenumber AS joint_goal_participation, CAST(CAST(l_quantity AS DECIMAL(10,1)) AS VARCHAR) AS minutes_played_with
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTES["raw_team_seasons"] = """
  SELECT draw || '.0' AS season_draws, '' || won AS season_wins, '-' AS season_losses, '' || points AS season_points
  FROM standings WHERE standing_type = 'TOTAL'"""
CTES["raw_team_children"] = """
  SELECT CASE WHEN s_suppkey % 10 <> 9 THEN ' ' || s_nationkey END AS parent_team_id FROM supplier"""
CTES["by_position"] = f"""
  SELECT player_main_position, count(*) AS total_players, {_COMMON},
    {_avg4('goals_per_90min')} AS avg_goals_per_90min, {_avg4('assists_per_90min')} AS avg_assists_per_90min,
    {_avg4('age')} AS avg_age,
    count(*) FILTER (WHERE injury_risk_level = 'HIGH') AS high_risk_count,
    count(*) FILTER (WHERE injury_risk_level = 'MEDIUM') AS medium_risk_count,
    count(*) FILTER (WHERE injury_risk_level = 'LOW') AS low_risk_count
  FROM profile WHERE player_main_position IS NOT NULL GROUP BY player_main_position"""
CTES["venues"] = """
  SELECT c_nationkey AS team_id, year(o_orderdate) AS season_id, o_orderstatus, o_orderkey, o_custkey,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HOME' ELSE 'AWAY' END AS venue
  FROM orders JOIN customer ON o_custkey = c_custkey"""
CTES["results"] = """
  SELECT team_id, season_id, standing_type, count(*) AS played_games,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS won, count(*) FILTER (WHERE o_orderstatus = 'P') AS draw,
    count(*) FILTER (WHERE o_orderstatus = 'O') AS lost, CAST(sum(o_orderkey % 4) AS BIGINT) AS goals_for,
    CAST(sum(o_custkey % 4) AS BIGINT) AS goals_against
  FROM (SELECT *, venue AS standing_type FROM venues UNION ALL SELECT *, 'TOTAL' FROM venues)
  GROUP BY ALL"""
CTES["standings"] = """
  SELECT *, rank() OVER (PARTITION BY competition_id, season_id, standing_type
      ORDER BY points DESC, goal_difference DESC, goals_for DESC) AS position
  FROM (SELECT r_regionkey AS competition_id, r_name AS competition_name, left(r_name, 2) AS competition_code,
      'LEAGUE' AS competition_type, season_id, 'REGULAR_SEASON' AS stage, standing_type,
      CASE WHEN team_id % 2 = 0 THEN 'Group A' END AS group_name, team_id, n_name AS team_name,
      'T' || team_id AS team_tla, 'https://crest/' || team_id AS team_crest_url, played_games, won, draw, lost,
      won * 3 + draw AS points, goals_for, goals_against, goals_for - goals_against AS goal_difference,
      (CASE WHEN won > lost THEN 'W' ELSE 'L' END) || (CASE WHEN draw % 2 = 0 THEN 'D' ELSE '' END) AS form
    FROM results JOIN nation ON team_id = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
CTES["competitions"] = """
  SELECT r_regionkey AS competition_id, r_name AS competition_name, left(r_name, 2) AS competition_code,
    'LEAGUE' AS competition_type, 'area ' || r_name AS area_name,
    last_year + CASE WHEN r_regionkey = 4 THEN 1 ELSE 0 END AS current_season_id, r_regionkey + 30 AS current_matchday
  FROM region LEFT JOIN (SELECT n_regionkey, max(season_id) AS last_year FROM venues JOIN nation ON team_id = n_nationkey
    GROUP BY n_regionkey) ON r_regionkey = n_regionkey"""
CTES["current_totals"] = """
  SELECT s.*, c.current_matchday, c.area_name, c.current_season_id || '-12-31' AS season_end_date
  FROM standings s JOIN competitions c ON s.competition_id = c.competition_id AND s.season_id = c.current_season_id
  WHERE standing_type = 'TOTAL'"""
CTES["rankings"] = f"""
  SELECT competition_id, competition_name, competition_code, season_id, stage, group_name, position, team_id, team_name,
    team_tla, team_crest_url, played_games, won, draw, lost, points, goals_for, goals_against, goal_difference, form,
    current_matchday, area_name, {_r('points / nullif(played_games, 0)', 2)} AS points_per_game,
    {_r('goals_for / nullif(played_games, 0)', 2)} AS goals_scored_per_game,
    {_r('goals_against / nullif(played_games, 0)', 2)} AS goals_conceded_per_game,
    {_r('won / nullif(played_games, 0) * 100', 1)} AS win_percentage,
    rank() OVER (PARTITION BY competition_id, season_id, stage ORDER BY points DESC, goal_difference DESC, goals_for DESC) AS overall_rank
  FROM current_totals"""
CTES["live"] = """
  SELECT user_id AS match_id, ts AS event_timestamp, event_type AS status, event_id % 90 AS minute,
    'League ' || (user_id % 8) AS competition_name, 'L' || (user_id % 8) AS competition_code,
    'H' || (user_id % 20) AS home_team_name, CASE WHEN user_id % 29 <> 0 THEN 'A' || (user_id % 17) END AS away_team_name,
    CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value) AS BIGINT) % 5 END AS home_score,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS away_score,
    CAST(floor(value) AS BIGINT) % 5 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS total_goals,
    CASE WHEN CAST(floor(value) AS BIGINT) % 5 > CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 THEN 'HOME'
         WHEN CAST(floor(value) AS BIGINT) % 5 < CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 THEN 'AWAY'
         ELSE 'DRAW' END AS match_result,
    'V' || (user_id % 5) AS venue, event_type <> 'signup' AS is_live
  FROM events"""
_SCORE = """'{' || CASE WHEN o_orderstatus <> 'F' THEN '' WHEN o_orderkey % 2 = 0 THEN '"winner":"HOME_TEAM",' ELSE '"winner":"AWAY_TEAM",' END
      || '"fullTime":{' || CASE WHEN o_orderkey % 6 <> 0 THEN '"home":' || (o_orderkey % 6) || ',' ELSE '' END || '"away":' || (o_orderkey % 4) || '}}'"""
CTES["matches"] = f"""
  SELECT o_orderkey AS match_id, {_ts('o_orderdate + INTERVAL 7 HOUR')} AS utc_date, '2024-01-02 10:04:05.000000' AS last_updated,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'IN_PLAY' ELSE 'SCHEDULED' END AS status,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 38 ELSE 0 END AS matchday,
    CASE WHEN o_orderkey % 4 = 0 THEN 'REGULAR_SEASON' ELSE 'UNKNOWN' END AS stage,
    o_orderkey % 5 AS area_id, 'Area' AS area_name, CAST(NULL AS VARCHAR) AS area_code,
    o_orderkey % 7 AS competition_id, 'Cup ' || (o_orderkey % 7) AS competition_name, CAST(NULL AS VARCHAR) AS competition_code,
    year(o_orderdate) AS season_id, year(o_orderdate) || '-01-01' AS season_start_date, CAST(NULL AS VARCHAR) AS season_end_date,
    o_orderkey % 20 AS home_team_id, 'Home ' || (o_orderkey % 20) AS home_team_name,
    CAST(NULL AS VARCHAR) AS home_team_short_name, CAST(NULL AS VARCHAR) AS home_team_tla,
    o_custkey AS away_team_id, 'Away ' || o_custkey AS away_team_name,
    CAST(NULL AS VARCHAR) AS away_team_short_name, CAST(NULL AS VARCHAR) AS away_team_tla,
    CASE WHEN o_orderstatus <> 'F' THEN 'DRAW' WHEN o_orderkey % 2 = 0 THEN 'HOME_TEAM' ELSE 'AWAY_TEAM' END AS winner,
    'REGULAR' AS duration, o_orderkey % 6 AS ft_home_goals, o_orderkey % 4 AS ft_away_goals,
    CAST(0 AS BIGINT) AS ht_home_goals, CAST(0 AS BIGINT) AS ht_away_goals,
    '{{"id":"' || (o_orderkey % 5) || '","name":"Area"}}' AS area_details,
    '{{"id":"' || (o_orderkey % 7) || '","name":"Cup ' || (o_orderkey % 7) || '"}}' AS competition_details,
    '{{"id":"' || (o_orderkey % 20) || '","name":"Home ' || (o_orderkey % 20) || '","crest":"c/' || (o_orderkey % 20) || '"}}' AS home_team_details,
    '{{"id":"' || o_custkey || '","name":"Away ' || o_custkey || '"}}' AS away_team_details, CAST(NULL AS VARCHAR) AS referees,
    '{{"id":"' || year(o_orderdate) || '","startDate":"' || year(o_orderdate) || '-01-01","endDate":"bad","winner":"{{\\"id\\":3}}"}}' AS season_details,
    {_SCORE} AS score_details,
    '{{"id":' || o_orderkey || ',"utcDate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","status":"'
      || CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'IN_PLAY' ELSE 'SCHEDULED' END || '"'
      || CASE WHEN o_orderkey % 3 = 0 THEN ',"matchday":' || (o_orderkey % 38) ELSE '' END
      || CASE WHEN o_orderkey % 4 = 0 THEN ',"stage":"REGULAR_SEASON"' ELSE '' END || ',"lastUpdated":"2024-01-02T03:04:05Z","area":{{"id":'
      || (o_orderkey % 5) || ',"name":"Area"}},"competition":{{"id":' || (o_orderkey % 7) || ',"name":"Cup ' || (o_orderkey % 7) || '"}},"season":{{"id":'
      || year(o_orderdate) || ',"startDate":"' || year(o_orderdate) || '-01-01","endDate":"bad","winner":{{"id":3}}}},"homeTeam":{{"id":' || (o_orderkey % 20)
      || ',"name":"Home ' || (o_orderkey % 20) || '","crest":"c/' || (o_orderkey % 20) || '"}},"awayTeam":{{"id":' || o_custkey || ',"name":"Away ' || o_custkey
      || '"}},"score":' || {_SCORE} || '}}' AS raw
  FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 31 <> 0"""
CTES["table_rows"] = """
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 'TOTAL' END AS kind, 1 AS place, l_suppkey AS number, CAST(l_quantity AS BIGINT) AS pts FROM lineitem
  UNION ALL
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 'TOTAL' END, 2, l_partkey, CAST(l_quantity AS BIGINT) - 1 FROM lineitem
  UNION ALL
  SELECT *, 'HOME', 1, l_suppkey, CAST(l_quantity AS BIGINT) FROM lineitem WHERE l_linestatus = 'F'"""
CTES["flat_standings"] = """
  SELECT l_orderkey AS competition_id, 'League ' || l_orderkey AS competition_name, 'L' AS competition_code,
    CAST(NULL AS VARCHAR) AS competition_type, CAST(2024 AS BIGINT) AS season_id, '2024-01-01' AS season_start_date,
    CAST(NULL AS VARCHAR) AS season_end_date, CAST(0 AS BIGINT) AS current_matchday, l_orderkey % 5 AS area_id, 'Area' AS area_name,
    CAST(NULL AS VARCHAR) AS area_code, 'REGULAR_SEASON' AS stage, COALESCE(kind, 'TOTAL') AS standing_type,
    l_returnflag AS group_name, place AS position, number AS team_id, 'S' || number AS team_name,
    CAST(NULL AS VARCHAR) AS team_short_name, CAST(NULL AS VARCHAR) AS team_tla, CAST(NULL AS VARCHAR) AS team_crest_url,
    CASE WHEN l_partkey % 3 = 0 THEN l_linenumber ELSE 0 END AS played_games, CAST(0 AS BIGINT) AS won,
    CAST(0 AS BIGINT) AS draw, CAST(0 AS BIGINT) AS lost, pts AS points, CAST(0 AS BIGINT) AS goals_for,
    CAST(0 AS BIGINT) AS goals_against, CAST(0 AS BIGINT) AS goal_difference, 'WDL' AS form
  FROM table_rows WHERE number % 10 <> 0 AND l_orderkey % 9 <> 0 AND l_orderkey % 13 <> 0"""
CTES["event_batches"] = """
  SELECT user_id, ts, event_id, event_type, event_id % 7 AS _batch FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 7 ORDER BY ts DESC) = 1"""


def _needs(sql: str) -> list[str]:
    """CTEs a statement uses, each after those it uses itself."""
    ordered: list[str] = []
    for name in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql)):
        if name in CTES:
            for inner in [*_needs(CTES[name]), name]:
                if inner not in ordered:
                    ordered.append(inner)
    return ordered


def statement(final: str) -> str:
    ctes = _needs(final)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in ctes)
    return f"WITH {head}\n{final}" if ctes else final


_Q: dict[str, str] = {}
_Q["form_metrics"] = "SELECT * FROM form"
_Q["value_summary"] = "SELECT * REPLACE (CAST(latest_valuation_timestamp AS VARCHAR) AS latest_valuation_timestamp) FROM value_trends"
_Q["value_timeline"] = """
SELECT player_id, CAST(date_unix AS VARCHAR) AS date_unix, value, prev_value, next_value, value - prev_value AS value_change,
  CASE WHEN prev_value > 0 THEN (value - prev_value) / prev_value * 100 ELSE 0.0 END AS value_change_pct,
  CASE WHEN value > prev_value THEN 'INCREASING' WHEN value < prev_value THEN 'DECREASING' ELSE 'STABLE' END AS trend_direction
FROM (SELECT *, lag(value) OVER w AS prev_value, lead(value) OVER w AS next_value FROM values_
  WINDOW w AS (PARTITION BY player_id ORDER BY date_unix))"""
_Q["injury_risk"] = "SELECT * FROM risk"
_Q["transfer_intel"] = "SELECT * REPLACE (CAST(last_transfer_date AS VARCHAR) AS last_transfer_date) FROM deals"
_Q["left_chain_join"] = """
SELECT player_id, player_name, total_seasons, value_records_count, total_injuries, total_transfers
FROM profiles LEFT JOIN form USING (player_id) LEFT JOIN value_trends USING (player_id)
LEFT JOIN risk USING (player_id) LEFT JOIN deals USING (player_id)"""
_Q["profile_scores"] = "SELECT player_id, performance_score, market_score, health_score, overall_player_score FROM scored"
_DATES_360 = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("date_of_birth", "latest_valuation_timestamp", "last_transfer_date"))
_Q["profile_360"] = f"SELECT * REPLACE ({_DATES_360}) FROM profile"
_Q["pipeline_run"] = _Q["profile_360"]
_Q["global_ranking"] = f"""
SELECT o_orderkey, score, row_number() OVER (ORDER BY score DESC, md5(CAST(o_orderkey AS VARCHAR))) AS position,
  percent_rank() OVER (ORDER BY score DESC) AS percentile
FROM (SELECT o_orderkey, {_r('o_totalprice / 5000', 2)} AS score FROM orders)"""
_Q["partition_ranking"] = """
SELECT *, rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY quantity DESC, lines DESC) AS place
FROM (SELECT l_orderkey, l_suppkey, l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS lines
  FROM lineitem GROUP BY ALL)"""
_Q["latest_event_by_user"] = f"""
SELECT user_id, {_ts('ts')} AS ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1"""
_Q["drop_duplicates"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1"""
_Q["clean_profiles"] = """
SELECT player_id, player_slug, player_name, CAST(NULL AS VARCHAR) AS player_image_url,
  CAST(date_of_birth AS VARCHAR) AS date_of_birth, place_of_birth, country_of_birth, height, citizenship, citizenship_country,
  position, foot, current_club_id, '2020-07-01' AS joined, CAST(contract_expires AS VARCHAR) AS contract_expires,
  CAST(NULL AS VARCHAR) AS social_media_url, player_main_position
FROM profiles"""
_Q["clean_performances"] = "SELECT * FROM performances"
_Q["clean_values"] = "SELECT * REPLACE (CAST(date_unix AS VARCHAR) AS date_unix) FROM values_"
_Q["clean_injuries"] = "SELECT * REPLACE (CAST(from_date AS VARCHAR) AS from_date, CAST(end_date AS VARCHAR) AS end_date) FROM injuries"
_Q["clean_transfers"] = "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM transfers"
_Q["clean_teams"] = """
SELECT '' || s_suppkey AS club_id, 'club-' || s_suppkey AS club_slug, s_name AS club_name, CAST(NULL AS VARCHAR) AS logo_url,
  n_name AS country_name, '2024' AS season_id, '' || n_regionkey AS competition_id, 'slug' AS competition_slug,
  'name' AS competition_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'First' END AS club_division, 'src' AS source_url
FROM supplier JOIN nation ON s_nationkey = n_nationkey CROSS JOIN (VALUES (0), (1)) AS pads(pad)
WHERE pad = 0 OR s_suppkey % 5 = 0"""
_Q["clean_national"] = """
SELECT o_custkey AS player_id, o_orderpriority AS team_id,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS first_game_date,
  o_orderkey % 90 AS matches, CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE o_orderkey % 30 END AS goals
FROM orders WHERE o_orderkey % 100 <> 3"""
_Q["clean_teammates"] = """
SELECT o_custkey AS player_id, '' || l_suppkey AS teammate_player_id, 'S' || l_suppkey AS player_with_name,
  CASE WHEN l_linenumber = 2 THEN 0.0::DOUBLE ELSE CAST(CAST(l_tax AS DECIMAL(10,2)) AS DOUBLE) END AS ppg_played_with,
  l_linenumber AS joint_goal_participation, CAST(trunc(l_quantity) AS BIGINT) AS minutes_played_with
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey % 50 <> 7"""
_Q["clean_team_seasons"] = """
SELECT '' || team_id AS club_id, '' || competition_id AS competition_id, competition_name, team_name, '' || season_id AS season_season,
  position AS season_rank, draw AS season_draws, won AS season_wins, CAST(0 AS BIGINT) AS season_losses, points AS season_points,
  goals_for AS season_goals_for, goals_against AS season_goals_against, goal_difference AS season_goal_difference,
  ' ' || form AS extra_form
FROM standings WHERE standing_type = 'TOTAL'"""
_Q["clean_team_children"] = """
SELECT '' || n_nationkey AS parent_team_id, n_name AS parent_team_name, 'c' || s_suppkey AS child_team_id, s_name AS child_team_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 <> 9"""
_Q["height_normalise"] = """
SELECT c_custkey,
  CASE WHEN c_custkey % 300 = 0 THEN NULL WHEN c_custkey % 300 < 10 THEN (c_custkey % 300) * 100 ELSE c_custkey % 300 END AS height_cm,
  CAST(trunc(CAST('1.' || lpad('' || (c_custkey % 100), 2, '0') AS DOUBLE) * 100) AS BIGINT) AS truncated_cm,
  100 + c_custkey % 100 AS nearest_cm
FROM customer"""
_Q["utc_shift"] = f"""
SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN {_ts("date_trunc('second', ts)")} END AS utc,
  CASE WHEN event_id % 17 <> 0 THEN {_ts("date_trunc('second', ts) + INTERVAL 7 HOUR")} END AS local
FROM events"""
_Q["anti_join_orphans"] = """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
_Q["conditional_sums"] = """
SELECT o_custkey, count(*) AS matches, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS wins,
  count(*) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice > 100000) AS big_open
FROM orders GROUP BY o_custkey"""
_Q["count_distinct_users"] = """
SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS events, count(*) FILTER (WHERE value > 50) AS large
FROM events GROUP BY event_type"""
_Q["having_duplicates"] = """
SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
_Q["duplicate_members"] = """
SELECT 'lineitem' AS table_name, 'unique(l_orderkey,l_linenumber)' AS rule, 'ERROR' AS severity,
  count(*) FILTER (WHERE n > 1) AS bad_rows, count(*) AS total_rows
FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)"""


def _profile_row(column: str, kind: str) -> str:
    return f"""SELECT 'players' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count(*) - count({column}) AS null_rows,
  {_r(f'(count(*) - count({column})) / count(*) * 100', 2)} AS null_pct, (count(*) - count({column})) / count(*) * 100 > 50 AS high_missing
FROM profiles LEFT JOIN risk USING (player_id)"""


_Q["null_profile"] = "\nUNION ALL\n".join(
    _profile_row(c, k)
    for c, k in (
        ("player_id", "bigint"),
        ("player_name", "string"),
        ("height", "int"),
        ("total_injuries", "bigint"),
        ("injury_risk_level", "string"),
    )
)
_Q["value_counts_top10"] = """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 10"""
_Q["global_aggregate"] = f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE l_quantity = 0) AS zero_rows, count(*) FILTER (WHERE l_quantity < 0) AS negative_rows,
  min(l_quantity) AS min_value, max(l_quantity) AS max_value, {_r('avg(l_quantity)', 6)} AS mean_value, 0.0::DOUBLE AS zero_pct
FROM lineitem"""
_Q["union_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
    for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
)
_Q["load_report"] = f"SELECT *, 'SUCCESS' AS status FROM ({_Q['union_counts']})"
_Q["top_players"] = """
SELECT player_id, player_name, age, player_main_position, overall_player_score, performance_score, market_score, health_score,
  player_rank, peak_market_value, latest_market_value, CAST(latest_valuation_timestamp AS VARCHAR) AS latest_valuation_timestamp,
  total_goals, total_assists, injury_risk_level
FROM profile WHERE overall_player_score > 0 ORDER BY overall_player_score DESC, player_id LIMIT 100"""
_Q["high_value_low_risk"] = "SELECT * FROM safe ORDER BY peak_market_value DESC, player_id"
_Q["transfer_opportunities"] = "SELECT * FROM opportunities ORDER BY opportunity_score DESC, overall_player_score DESC, player_id"
_Q["position_stats"] = "SELECT * FROM by_position"
_Q["positions_by_score"] = "SELECT * FROM by_position ORDER BY avg_overall_score DESC"
_Q["positions_by_size"] = "SELECT * FROM by_position ORDER BY total_players DESC, player_main_position"
_Q["age_groups"] = f"""
SELECT CASE WHEN age < 21 THEN 'U21' WHEN age BETWEEN 21 AND 25 THEN '21-25' WHEN age BETWEEN 26 AND 30 THEN '26-30'
    WHEN age BETWEEN 31 AND 35 THEN '31-35' ELSE '35+' END AS age_group, count(*) AS total_players, {_COMMON},
  {_avg4('injury_severity_score')} AS avg_injury_score, {_avg4('total_transfers')} AS avg_transfers
FROM profile WHERE age IS NOT NULL GROUP BY 1"""
_Q["four_way_join"] = """
SELECT p.player_id, p.player_name, p.age, p.player_main_position, f.total_goals, f.goals_per_90min, r.injury_risk_level, v.peak_market_value
FROM profile p JOIN form f USING (player_id) JOIN risk r USING (player_id) JOIN value_trends v USING (player_id)
WHERE f.total_goals > 3 AND r.injury_risk_level = 'LOW' ORDER BY f.goals_per_90min DESC NULLS LAST, p.player_id LIMIT 20"""
_Q["young_opportunities"] = "SELECT * FROM opportunities WHERE age < 28 ORDER BY overall_player_score DESC, player_id LIMIT 20"
_Q["valuable_safe_players"] = "SELECT * FROM safe WHERE latest_market_value > 10000000 ORDER BY overall_player_score DESC, player_id LIMIT 20"
_Q["league_table"] = "SELECT * FROM standings"
_Q["current_standings"] = """
SELECT competition_name, competition_code, stage, group_name, position, team_name, team_tla, played_games, won, draw, lost, points,
  goals_for, goals_against, goal_difference, form, current_matchday, season_end_date
FROM current_totals"""
_Q["top_teams"] = f"""
SELECT team_name, team_tla, competition_name, position, points, played_games, goal_difference, goals_for,
  {_r('points / nullif(played_games, 0)', 2)} AS points_per_game, {_r('goals_for / nullif(played_games, 0)', 2)} AS goals_per_game, form
FROM current_totals WHERE position <= 5
ORDER BY points DESC, goal_difference DESC, goals_for DESC, competition_id, team_id LIMIT 100"""
_Q["conditional_left_join"] = f"""
SELECT c.competition_id, c.competition_name, c.competition_code, c.competition_type, c.area_name, c.current_matchday,
  c.current_season_id || '-01-01' AS season_start_date, c.current_season_id || '-12-31' AS season_end_date,
  count(DISTINCT s.team_id) AS total_teams, CAST(sum(s.goals_for) AS BIGINT) AS total_goals,
  {_r('avg(s.goals_for + s.goals_against) / nullif(avg(s.played_games), 0)', 2)} AS avg_goals_per_game,
  max(s.points) AS max_points, min(s.points) AS min_points
FROM competitions c LEFT JOIN standings s ON c.competition_id = s.competition_id AND c.current_season_id = s.season_id
  AND s.standing_type = 'TOTAL'
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""
_Q["home_away"] = """
SELECT h.team_name, c.competition_name, h.points AS home_points, a.points AS away_points, h.points + a.points AS total_points,
  h.goals_for AS home_goals_for, a.goals_for AS away_goals_for, h.goals_against AS home_goals_against,
  a.goals_against AS away_goals_against, h.points - a.points AS home_advantage,
  CASE WHEN h.points > a.points THEN 'Stronger at home' WHEN h.points < a.points THEN 'Stronger away' ELSE 'Balanced' END AS performance_type
FROM standings h JOIN standings a ON h.competition_id = a.competition_id AND h.season_id = a.season_id AND h.team_id = a.team_id
JOIN competitions c ON h.competition_id = c.competition_id AND h.season_id = c.current_season_id
WHERE h.standing_type = 'HOME' AND a.standing_type = 'AWAY'"""
_Q["competition_rankings"] = "SELECT * FROM rankings"
_Q["snapshot_refresh"] = "SELECT * FROM rankings"
_Q["standings_filters"] = """
SELECT * FROM standings
WHERE standing_type = 'TOTAL' AND competition_code = 'AS' AND group_name = 'Group A'"""
_Q["best_by_points"] = """
SELECT team_name, competition_name, position, points, goal_difference FROM standings WHERE standing_type = 'TOTAL'
ORDER BY points DESC, goal_difference DESC, competition_id, season_id, team_id LIMIT 10"""
_Q["rankings_filter"] = """
SELECT * FROM rankings WHERE competition_code = 'AM'
ORDER BY position, stage, group_name NULLS LAST, team_id LIMIT 20"""
_Q["current_live"] = f"""
SELECT match_id, competition_name, home_team_name, away_team_name, home_score, away_score, total_goals,
  home_team_name || ' ' || COALESCE('' || home_score, '0') || '-' || COALESCE('' || away_score, '0') || ' ' || away_team_name AS match_summary,
  CASE WHEN home_score > away_score THEN home_team_name WHEN away_score > home_score THEN away_team_name ELSE 'DRAW' END AS leading_team,
  status, minute, venue, {_ts('event_timestamp')} AS last_updated
FROM live WHERE is_live QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY event_timestamp DESC) = 1"""
_Q["score_progression"] = f"""
SELECT match_id, {_ts('event_timestamp')} AS event_timestamp, minute, home_team_name, away_team_name, home_score, away_score,
  total_goals, match_result, competition_name
FROM live ORDER BY match_id, event_timestamp"""
_Q["competition_live_summary"] = f"""
SELECT competition_name, competition_code, count(DISTINCT match_id) AS total_matches, CAST(sum(total_goals) AS BIGINT) AS total_goals,
  {_r('avg(total_goals)', 2)} AS avg_goals_per_match, max(total_goals) AS max_goals_in_match,
  count(*) FILTER (WHERE is_live) AS currently_live
FROM live GROUP BY competition_name, competition_code"""
_Q["interval_filter"] = f"""
SELECT * REPLACE ({_ts('event_timestamp')} AS event_timestamp) FROM live
WHERE event_timestamp > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 6 HOUR"""
_Q["retention"] = f"""
SELECT event_id, {_ts('ts')} AS ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY"""
_Q["retention_delete"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS events,
  (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-13 12:00:00') AS deleted
FROM events WHERE ts >= TIMESTAMP '2024-01-13 12:00:00' GROUP BY 1"""
_Q["json_props"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events"""
_Q["json_match"] = "SELECT * FROM matches"
_Q["json_unreadable"] = "SELECT count(*) AS broken, CAST(40 AS BIGINT) AS longest FROM orders WHERE o_orderkey % 50 = 0"
_Q["json_competition"] = """
SELECT c_custkey AS competition_id, c_name AS competition_name, 'C' || c_nationkey AS competition_code, 'LEAGUE' AS competition_type,
  CAST(NULL AS VARCHAR) AS emblem_url, CAST(NULL AS VARCHAR) AS plan, c_nationkey AS area_id, c_mktsegment AS area_name,
  CAST(NULL AS VARCHAR) AS area_code, CAST(NULL AS VARCHAR) AS area_flag_url,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS current_season_id,
  CASE WHEN c_custkey % 5 <> 0 THEN '2023-08-01' END AS season_start_date,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 = 0 THEN '2024-05-31' END AS season_end_date,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 = 0 THEN c_custkey % 38 ELSE 0 END AS current_matchday,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 4 = 0 THEN c_custkey + 1 END AS season_winner_id,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 4 = 0 THEN 'Winner' END AS season_winner_name,
  CASE WHEN c_custkey % 7 = 0 THEN c_custkey % 50 ELSE 0 END AS number_of_available_seasons,
  '2024-01-02 03:04:05.000000' AS last_updated
FROM customer WHERE c_custkey % 11 <> 0"""
_Q["competitions_load"] = _Q["json_competition"]
_Q["json_standings"] = "SELECT * FROM flat_standings"
_Q["live_match_line"] = """
SELECT match_id, home_team_name || ' ' || ft_home_goals || '-' || ft_away_goals || ' ' || away_team_name AS match, competition_name, status, last_updated
FROM matches WHERE status = 'IN_PLAY'"""
_Q["home_wins"] = """
SELECT home_team_name, count(*) AS matches, CAST(sum(CASE WHEN winner = 'HOME_TEAM' THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM matches GROUP BY home_team_name"""
_Q["home_matches"] = "SELECT * FROM matches WHERE home_team_name = 'Home 3' AND status = 'FINISHED'"
_Q["team_logos"] = "SELECT match_id, home_team_name, 'c/' || home_team_id AS logo_url FROM matches"
_Q["upsert_last_writer"] = f"""
SELECT user_id, {_ts('ts')} AS ts, event_id, event_type, _batch FROM event_batches
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _batch DESC) = 1"""
_Q["upsert_latest_event"] = f"""
SELECT user_id, {_ts('ts')} AS ts, event_id, event_type, _batch FROM event_batches
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""
_Q["upsert_null_key"] = """
SELECT competition_id, season_id, stage, standing_type, team_id,
  CASE WHEN standing_type = 'AWAY' THEN group_name ELSE COALESCE(group_name, '') END AS group_name, position,
  points + CASE WHEN standing_type = 'AWAY' THEN 0 ELSE 1000 END AS points
FROM standings"""
_Q["upsert_partial"] = f"""
SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, {_ts('o_orderdate')} AS o_orderdate,
  CASE WHEN o_orderstatus = 'P' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders"""
# The flattened newest message of every user; all columns but the time of processing.
CTES["event_matches"] = f"""
  SELECT user_id AS match_id, {_ts("date_trunc('second', ts) + INTERVAL 7 HOUR")} AS utc_date,
    {_ts("make_timestamp(CAST((1700000000 + event_id) * 1000000 AS BIGINT)) + INTERVAL 7 HOUR")} AS last_updated,
    upper(event_type) AS status, CAST(0 AS BIGINT) AS matchday, 'UNKNOWN' AS stage,
    CAST(NULL AS BIGINT) AS area_id, CAST(NULL AS VARCHAR) AS area_name, CAST(NULL AS VARCHAR) AS area_code,
    CAST(NULL AS BIGINT) AS competition_id, CAST(NULL AS VARCHAR) AS competition_name, CAST(NULL AS VARCHAR) AS competition_code,
    CAST(NULL AS BIGINT) AS season_id, CAST(NULL AS VARCHAR) AS season_start_date, CAST(NULL AS VARCHAR) AS season_end_date,
    user_id % 20 AS home_team_id, 'H' || (user_id % 20) AS home_team_name, CAST(NULL AS VARCHAR) AS home_team_short_name, CAST(NULL AS VARCHAR) AS home_team_tla,
    CAST(NULL AS BIGINT) AS away_team_id, CAST(NULL AS VARCHAR) AS away_team_name, CAST(NULL AS VARCHAR) AS away_team_short_name, CAST(NULL AS VARCHAR) AS away_team_tla,
    'DRAW' AS winner, 'REGULAR' AS duration, CAST(floor(value) AS BIGINT) % 5 AS ft_home_goals, CAST(1 AS BIGINT) AS ft_away_goals,
    CAST(0 AS BIGINT) AS ht_home_goals, CAST(0 AS BIGINT) AS ht_away_goals,
    CAST(NULL AS VARCHAR) AS area_details, CAST(NULL AS VARCHAR) AS competition_details, CAST(NULL AS VARCHAR) AS season_details,
    '{{"id":"' || (user_id % 20) || '","name":"H' || (user_id % 20) || '"}}' AS home_team_details, CAST(NULL AS VARCHAR) AS away_team_details,
    '{{"fullTime":{{"home":' || (CAST(floor(value) AS BIGINT) % 5) || ',"away":1}}}}' AS score_details, CAST(NULL AS VARCHAR) AS referees,
    '{{"id":' || user_id || ',"utcDate":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","status":"' || upper(event_type) || '","lastUpdated":"'
      || strftime(make_timestamp(CAST((1700000000 + event_id) * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') || '","homeTeam":{{"id":' || (user_id % 20)
      || ',"name":"H' || (user_id % 20) || '"}},"score":{{"fullTime":{{"home":' || (CAST(floor(value) AS BIGINT) % 5) || ',"away":1}}}}}}' AS raw
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
_Q["stream_upsert"] = "SELECT * FROM event_matches"
_Q["stream_restart"] = "SELECT * FROM event_matches"
_Q["merged_state"] = "SELECT * FROM event_matches CROSS JOIN (VALUES (false), (true)) AS phases(compacted)"
_Q["stream_competitions"] = _Q["json_competition"]
_Q["stream_standings"] = """
SELECT * FROM flat_standings QUALIFY row_number() OVER (PARTITION BY competition_id, season_id, stage, standing_type, team_id, group_name
  ORDER BY position, played_games, points) = 1"""
_Q["event_windows"] = f"""
WITH lots AS (
  SELECT *, least(CAST(ts AS DATE) - DATE '2024-01-01', 29) // 10 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS lot,
    time_bucket(INTERVAL 5 MINUTE, ts) AS opened FROM events),
seen AS (SELECT lot, max(ts) AS latest FROM lots GROUP BY lot),
marks AS (SELECT n.lot, max(s.latest) - INTERVAL 2 DAY AS mark FROM range(5) AS n(lot) LEFT JOIN seen s ON s.lot < n.lot GROUP BY n.lot)
SELECT {_ts("opened")} AS window_start, {_ts("opened + INTERVAL 5 MINUTE")} AS window_end, event_type, count(*) AS events, min(event_id) AS first_event
FROM lots JOIN marks USING (lot) WHERE mark IS NULL OR opened + INTERVAL 5 MINUTE > mark
GROUP BY opened, event_type HAVING opened + INTERVAL 5 MINUTE <= (SELECT mark FROM marks WHERE lot = 4)"""
_Q["value_change"] = """
SELECT *, current_market_value - value_1y_ago AS value_change_1y, current_market_value - value_3y_ago AS value_change_3y
FROM (SELECT player_id, arg_max(value, date_unix) FILTER (date_unix <= DATE '1998-06-30') AS current_market_value,
    arg_max(value, date_unix) FILTER (date_unix <= DATE '1997-06-30') AS value_1y_ago, arg_max(value, date_unix) FILTER (date_unix <= DATE '1995-06-30') AS value_3y_ago
  FROM values_ GROUP BY player_id)
WHERE current_market_value IS NOT NULL"""
_FORM_SPANS = {"last_season": 1, "last_3_seasons": 3}
_FORM_SUMS = ", ".join(
    f"CAST(sum({source}) FILTER (place <= {last}) AS BIGINT) AS {span}_{name}"
    for span, last in _FORM_SPANS.items()
    for source, name in (("goals", "goals"), ("assists", "assists"), ("minutes_played", "minutes"))
)
_FORM_RATES = ", ".join(
    f"{_per90(f'{span}_{what}', f'{span}_minutes')} AS {span}_{what}_per_90" for span in _FORM_SPANS for what in ("goals", "assists")
)
_Q["recent_form"] = f"""
SELECT *, {_FORM_RATES}, {", ".join(f"{span}_goals + {span}_assists AS {span}_goal_participation" for span in _FORM_SPANS)}
FROM (SELECT player_id, max(season_name) FILTER (place = 1) AS last_season, count(DISTINCT place) AS seasons_counted, {_FORM_SUMS}
  FROM (SELECT *, dense_rank() OVER (PARTITION BY player_id ORDER BY season_name DESC NULLS LAST) AS place FROM performances)
  WHERE place <= 3 GROUP BY player_id)"""
_Q["standings_dir"] = """
SELECT s_suppkey AS competition_id, s_name AS competition_name, CAST(NULL AS VARCHAR) AS competition_code, CAST(NULL AS VARCHAR) AS competition_type,
  CAST(2024 AS BIGINT) AS season_id, '2024-01-01' AS season_start_date, CAST(NULL AS VARCHAR) AS season_end_date,
  CASE WHEN s_suppkey % 6 = 0 THEN s_suppkey % 38 END AS current_matchday, s_nationkey AS area_id, 'Area' AS area_name, CAST(NULL AS VARCHAR) AS area_code,
  CASE WHEN s_suppkey % 11 <> 0 THEN 'REGULAR_SEASON' END AS stage, CASE WHEN s_suppkey % 9 <> 0 THEN 'TOTAL' END AS standing_type,
  CASE WHEN s_suppkey % 2 = 0 THEN 'G' END AS group_name, place AS position, s_suppkey * 2 + place AS team_id, 'T' || (s_suppkey * 2 + place) AS team_name,
  CAST(NULL AS VARCHAR) AS team_short_name, CAST(NULL AS VARCHAR) AS team_tla, CAST(NULL AS VARCHAR) AS team_crest_url,
  CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 30 WHEN s_suppkey % 2 <> 0 THEN 0 END AS played_games,
  CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey % 20 WHEN s_suppkey % 2 <> 0 THEN 0 END AS won,
  CAST(0 AS BIGINT) AS draw, CAST(0 AS BIGINT) AS lost, s_suppkey % 50 + place AS points, CAST(0 AS BIGINT) AS goals_for, CAST(0 AS BIGINT) AS goals_against,
  CAST(0 AS BIGINT) AS goal_difference, CASE WHEN s_suppkey % 5 = 0 THEN 'WDL' END AS form
FROM supplier CROSS JOIN (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS places(place) WHERE (s_suppkey * 2 + place) % 7 <> 0"""
_Q["standings_from_files"] = """
SELECT * EXCLUDE (known, rn) REPLACE (CASE WHEN known THEN 'old' ELSE competition_name END AS competition_name)
FROM (SELECT *, bool_or(points % 2 = 0) OVER k AS known,
    row_number() OVER (PARTITION BY competition_id, season_id, stage, standing_type, team_id, group_name
      ORDER BY points % 3 DESC, position, played_games, points) AS rn
  FROM flat_standings
  WINDOW k AS (PARTITION BY competition_id, season_id, stage, standing_type, team_id, group_name))
WHERE rn = 1"""
_Q["ingest_roundtrip"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'say "hi",' || chr(10) || o_orderpriority
    WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS note, o_totalprice, true AS has_lineage
FROM orders"""


# ---- quality: one row per rule --------------------------------------------------------------------


def _rule(source: str, table: str, rule: str, bad: str, severity: str = "ERROR", over: float | None = None) -> str:
    count = f"count(*) FILTER (WHERE {bad})"
    if over is not None:
        count = f"CASE WHEN {count} > count(*) * {over} THEN {count} ELSE 0 END"
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{severity}' AS severity, "
        f"CAST({count} AS BIGINT) AS bad_rows, count(*) AS total_rows FROM {source}"
    )


def _unique(source: str, table: str, keys: str, severity: str = "ERROR") -> str:
    return _rule(
        f"(SELECT count(*) OVER (PARTITION BY {keys}) AS n FROM {source})", table, f"unique({keys})", "n > 1", severity
    )


def _schema_row(table: str, rule: str, severity: str = "ERROR") -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{severity}' AS severity, CAST(0 AS BIGINT) AS bad_rows, CAST(1 AS BIGINT) AS total_rows"


def _size(source: str, table: str, low: int, high: int | None) -> str:
    outside = f"count(*) < {low}" + ("" if high is None else f" OR count(*) > {high}")
    return (
        f"SELECT '{table}' AS table_name, 'rows_between({low},{'' if high is None else high})' AS rule, 'WARNING' AS severity, "
        f"CASE WHEN {outside} THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS bad_rows, count(*) AS total_rows FROM {source}"
    )


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


# Raw tables: CTE, its columns with type and family, then columns that are never NULL and columns that are nothing else.
_TEXT = "string"
_LAYER: dict[str, tuple[str, str, str, str]] = {
    "player_profiles": (
        "raw_profiles",
        "player_id:bigint:int player_slug player_name date_of_birth:string:date place_of_birth country_of_birth height:string:float citizenship position "
        "foot current_club_id contract_expires:string:date main_position",
        "joined",
        "player_image_url social_media_url",
    ),
    "player_performances": (
        "raw_performances",
        "player_id:bigint:int season_name competition_id competition_name team_id team_name nb_in_group nb_on_pitch:string:int goals:string:int assists:string:int "
        "yellow_cards:string:int second_yellow_cards:string:int direct_red_cards penalty_goals:string:int minutes_played:string:float "
        "goals_conceded:string:int clean_sheets:string:int",
        "",
        "own_goals subed_in subed_out",
    ),
    "player_market_value": ("raw_values", "player_id:bigint:int date_unix:date:date value:string:float", "", ""),
    "player_injuries": (
        "raw_injuries",
        "player_id:bigint:int season_name injury_reason from_date:string:date end_date:string:date days_missed:string:float games_missed:string:int",
        "",
        "",
    ),
    "player_national_performances": ("raw_national", "player_id:bigint:int debut:string:date matches:string:int goals:string:int", "team_id", ""),
    "player_teammates_played_with": (
        "raw_teammates",
        "player_id:bigint:int teammate_player_id ppg_played_with:string:float joint_goal_participation:string:int minutes_played_with:string:float",
        "teammate_player_name",
        "",
    ),
    "transfer_history": (
        "raw_transfers",
        "player_id:bigint:int season_name transfer_date:string:date from_team_id from_team_name to_team_id to_team_name value_at_transfer:string:float "
        "transfer_fee:string:float",
        "",
        "",
    ),
    "team_details": (
        "raw_teams",
        "club_id club_division",
        "club_slug club_name country_name season_id competition_id competition_slug competition_name source_url",
        "logo_url",
    ),
    "team_competitions_seasons": (
        "raw_team_seasons",
        "season_draws:string:int season_wins:string:int season_losses:string:int season_points:string:int",
        "club_id competition_id competition_name team_name season_season season_rank season_goals_for season_goals_against season_goal_difference extra_form",
        "",
    ),
    "player_latest_market_value": ("raw_latest_values", "player_id:bigint:int latest_market_value:string:float value_date:date:date", "", ""),
    "team_children": ("raw_team_children", "parent_team_id", "parent_team_name child_team_id child_team_name", ""),
}


def _layer_columns(table: str) -> list[tuple[str, str, str | None, str]]:
    """Name, type, family and SQL of every column of a raw table."""
    _, own, filled, empty = _LAYER[table]
    out = []
    for entry in own.split():
        name, kind, family = entry.split(":") if ":" in entry else (entry, _TEXT, None)
        out.append((name, kind, family, name))
    out += [(name, _TEXT, None, "'x'") for name in filled.split()]
    return out + [(name, _TEXT, None, "CAST(NULL AS VARCHAR)") for name in empty.split()]


def _reads(column: str, family: str) -> str:
    if family == "date":
        return f"regexp_full_match(CAST({column} AS VARCHAR), '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST(CAST({column} AS VARCHAR) AS DATE) IS NOT NULL"
    if family == "int":
        return f"regexp_full_match(CAST({column} AS VARCHAR), '\\s*[+-]?\\d+(\\.0*)?\\s*')"
    return f"TRY_CAST({column} AS DOUBLE) IS NOT NULL"


def _text_rules(table: str, source: str | None = None) -> list[str]:
    source = source or _LAYER[table][0]
    columns = _layer_columns(table)
    out = [_rule(source, table, f"missing({name})", f"{sql} IS NULL", "WARNING", over=0.5) for name, _, _, sql in columns]
    return out + [
        _rule(source, table, f"{name} reads as {family}", f"{sql} IS NOT NULL AND NOT ({_reads(sql, family)})", "WARNING")
        for name, _, family, sql in columns
        if family
    ]


def _profiled(table: str, name: str, kind: str, family: str | None, sql: str) -> str:
    number = f"TRY_CAST({sql} AS DOUBLE)" if family in ("int", "float") else "CAST(NULL AS DOUBLE)"
    misfit = f"count(*) FILTER (WHERE {sql} IS NOT NULL AND NOT ({_reads(sql, family)}))" if family else "CAST(NULL AS BIGINT)"
    shown = f"'{family}'" if family else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, {shown} AS family, count(*) AS total_rows,
  count(*) - count({sql}) AS null_rows, {_r(f'(count(*) - count({sql})) / count(*) * 100', 2)} AS null_pct, {misfit} AS misfit_rows,
  min({number}) AS min_value, max({number}) AS max_value, {_r(f'avg({number})', 2)} AS mean_value,
  COALESCE((count(*) - count({sql})) / count(*) * 100 > 50, false) AS high_missing FROM {_LAYER[table][0]}"""


_Q["layer_profile"] = _all(*(_profiled(table, *column) for table in _LAYER for column in _layer_columns(table)))


def _source_rules(table: str, source: str | None = None) -> list[str]:
    """All findings of one raw table, by default as it is."""
    source = source or _LAYER[table][0]

    def rule(name: str, bad: str, severity: str = "ERROR", over: float | None = None) -> str:
        return _rule(source, table, name, bad, severity, over)

    rows = {
        "player_profiles": lambda: [
            rule("height_unusual", "TRY_CAST(height AS DOUBLE) < 140", "WARNING"),
            rule("birth_in_future", "TRY_CAST(date_of_birth AS DATE) > DATE '2024-06-30'", "WARNING"),
            rule("birth_before_1930", "TRY_CAST(date_of_birth AS DATE) < DATE '1930-01-01'", "WARNING"),
            *(_schema_row(table, f"has({c})") for c in ("player_id", "player_slug", "player_name")),
            _unique(source, table, "player_id"),
        ],
        "player_performances": lambda: [
            *(rule(f"{c}_negative", f"TRY_CAST({c} AS DOUBLE) < 0") for c in ("goals", "assists", "minutes_played", "yellow_cards")),
            rule("penalty_goals_above_goals", "TRY_CAST(penalty_goals AS DOUBLE) > TRY_CAST(goals AS DOUBLE)", "WARNING"),
            rule("second_yellow_above_yellow", "CAST(second_yellow_cards AS DOUBLE) > CAST(yellow_cards AS DOUBLE)", "WARNING"),
        ],
        "player_market_value": lambda: [
            rule("value_mostly_zero", "CAST(value AS DOUBLE) = 0", "WARNING", 0.5),
            rule("value_negative", "CAST(value AS DOUBLE) < 0"),
        ],
        "player_injuries": lambda: [
            rule("ends_before_start", "TRY_CAST(end_date AS DATE) < TRY_CAST(from_date AS DATE)"),
            rule("days_missed_negative", "CAST(days_missed AS DOUBLE) < 0", "WARNING"),
        ],
        "transfer_history": lambda: [
            rule("from_team_is_to_team", "from_team_id = to_team_id", "WARNING"),
            rule("transfer_fee_negative", "TRY_CAST(transfer_fee AS DOUBLE) < 0", "WARNING"),
            rule("free_transfer", "TRY_CAST(transfer_fee AS DOUBLE) = 0", "INFO"),
        ],
        "team_details": lambda: [_unique(source, table, "club_id")],
    }
    return [*rows.get(table, list)(), *_text_rules(table, source)]


_Q["dq_findings"] = _all(*(row for table in _LAYER for row in _source_rules(table)))
_TEAMS_NOW, _TEAMS_THEN = "(SELECT count(*) FROM raw_teams WHERE club_division IS NOT NULL)", "(SELECT count(*) FROM raw_teams)"


def _snapshot_rows(stored: str, changed: str) -> list[str]:
    head = "SELECT '{}' AS table_name, '{}' AS rule, '{}' AS severity, CAST({} AS BIGINT) AS bad_rows, CAST({} AS BIGINT) AS total_rows"
    return [
        head.format("teams", "stored", "ERROR", 0, stored),
        head.format("teams", "has_rows", "WARNING", 0, stored),
        head.format("teams", "rows_changed", "INFO", changed, stored),
        *(head.format("never_stored", rule, level, bad, 0) for rule, level, bad in (("stored", "ERROR", 1), ("has_rows", "WARNING", 1), ("rows_changed", "INFO", 0))),
    ]


_THEN = _all(*(r for t in ("transfer_history", "player_injuries", "player_profiles") for r in _source_rules(t)), *_snapshot_rows(_TEAMS_THEN, "0"))
_NOW = _all(
    *_source_rules("transfer_history", "(SELECT * FROM raw_transfers WHERE from_team_id <> to_team_id)"),
    *_source_rules("player_injuries", "(SELECT * FROM raw_injuries WHERE COALESCE(TRY_CAST(end_date AS DATE) >= TRY_CAST(from_date AS DATE), true))"),
    *_source_rules("player_market_value"),
    *_snapshot_rows(_TEAMS_NOW, f"{_TEAMS_THEN} - {_TEAMS_NOW}"),
)
_Q["quality_report"] = f"""
SELECT table_name, rule, COALESCE(b.severity, a.severity) AS severity, a.bad_rows AS previous_bad_rows, b.bad_rows AS bad_rows,
  a.total_rows AS previous_total_rows, b.total_rows AS total_rows,
  CASE WHEN a.bad_rows IS NULL THEN 'NEW' WHEN b.bad_rows IS NULL THEN 'GONE' WHEN a.bad_rows > 0 AND b.bad_rows = 0 THEN 'FIXED'
    WHEN a.bad_rows = 0 AND b.bad_rows > 0 THEN 'BROKEN' WHEN b.bad_rows > a.bad_rows THEN 'WORSE' WHEN b.bad_rows < a.bad_rows THEN 'BETTER' ELSE 'SAME' END AS state
FROM ({_THEN}) a FULL JOIN ({_NOW}) b USING (table_name, rule)"""
_GOLD = {
    "player_form_metrics": "form",
    "market_value_trends": "value_trends",
    "injury_risk_scores": "risk",
    "transfer_intelligence": "deals",
    "player_analytics_360": "profile",
}


def _constraints() -> list[str]:
    positive = {
        "player_form_metrics": ("total_seasons", "total_appearances", "total_goals", "goals_per_90min"),
        "market_value_trends": ("peak_market_value", "latest_market_value", "lowest_market_value", "value_records_count"),
        "injury_risk_scores": ("total_injuries", "total_days_missed"),
        "transfer_intelligence": ("total_transfers", "total_transfer_fees"),
    }
    level = ("injury_risk_level_known", "injury_risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH')")
    scores = ("performance_score", "market_score", "health_score", "overall_player_score", "player_rank_percentile")
    others = {
        "market_value_trends": [("peak_gte_lowest", "peak_market_value < lowest_market_value")],
        "injury_risk_scores": [level],
        "transfer_intelligence": [("transfer_value_trend_known", "transfer_value_trend NOT IN ('PROFIT', 'LOSS', 'STABLE')")],
        "player_analytics_360": [
            ("age_reasonable", "age NOT BETWEEN 14 AND 80"),
            ("height_reasonable", "height NOT BETWEEN 150 AND 220"),
            *((f"{s}_range", f"{s} NOT BETWEEN 0 AND 100") for s in scores),
            level,
        ],
    }
    present = {
        "player_form_metrics": (
            "player_id total_seasons total_appearances total_minutes_played total_goals total_assists goal_contributions "
            "total_yellow_cards total_red_cards"
        ),
        "market_value_trends": "player_id peak_market_value lowest_market_value value_volatility value_records_count",
        "injury_risk_scores": "player_id total_injuries total_days_missed total_games_missed",
        "transfer_intelligence": "player_id total_transfers",
        "player_analytics_360": "player_id player_name",
    }
    out = []
    for table, cte in _GOLD.items():
        out += [_rule(cte, table, f"{c}_positive", f"{c} < 0") for c in positive.get(table, ())]
        out += [_rule(cte, table, name, bad) for name, bad in others.get(table, ())]
        out += [_rule(cte, table, f"{c}_not_null", f"{c} IS NULL") for c in present[table].split()]
        out.append(_unique(cte, table, "player_id"))
    known = "'SCHEDULED', 'TIMED', 'IN_PLAY', 'PAUSED', 'FINISHED', 'POSTPONED', 'SUSPENDED', 'CANCELLED'"
    out.append(_rule("matches", "matches", "status_known", f"status NOT IN ({known})"))
    serving = {
        "live_events": ("live", "match_id event_timestamp", "match_id,event_timestamp"),
        "competitions": ("competitions", "competition_id competition_name competition_code", "competition_id"),
        "leaderboards": ("standings", "competition_id season_id position team_id team_name", "competition_id,season_id,stage,standing_type,team_id,group_name"),
    }
    for table, (cte, filled, keys) in serving.items():
        out += [_rule(cte, table, f"{c}_not_null", f"{c} IS NULL") for c in filled.split()]
        out.append(_unique(cte, table, keys))
    return out


def _fits() -> list[str]:
    out = []
    for table, cte in _GOLD.items():
        for column, kind in declared(table).items():
            longest = kind.removeprefix("varchar(").rstrip(")")
            lost = f"length({column}) > {longest}" if longest.isdigit() else f"{column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL"
            out.append(_rule(cte, table, f"fits({column} {kind})", lost))
    return out


_Q["constraint_checks"] = _all(*_constraints())
_Q["quality_verdict"] = f"""
SELECT count(*) FILTER (WHERE bad_rows > 0 AND severity = 'ERROR') AS errors,
  count(*) FILTER (WHERE bad_rows > 0 AND severity = 'WARNING') AS warnings, count(*) AS rules,
  count(*) FILTER (WHERE bad_rows > 0 AND severity = 'ERROR') = 0 AS passed
FROM ({_Q['constraint_checks']})"""
_Q["range_checks"] = _all(
    _rule("form", "player_form_metrics", "rate_above_cap", "goals_per_90min > 3 OR assists_per_90min > 3"),
    _rule("profile", "player_analytics_360", "goals_rate_above_cap", "goals_per_90min > 3"),
    _rule("profile", "player_analytics_360", "assists_rate_above_cap", "assists_per_90min > 3"),
    _rule("profile", "player_analytics_360", "performance_out_of_range", "performance_score NOT BETWEEN 0 AND 100"),
    *(
        _rule("profile", "player_analytics_360", f"{c}_not_null", f"{c} IS NULL")
        for c in ("player_id", "player_name", "overall_player_score")
    ),
    _rule("profile", "player_analytics_360", "height_often_missing", "height IS NULL", "WARNING", over=0.05),
    _rule("profile", "player_analytics_360", "goals_rate_often_missing", "goals_per_90min IS NULL", "WARNING", over=0.30),
    _rule("value_trends", "market_value_trends", "peak_negative", "peak_market_value < 0"),
    *(
        _schema_row("player_analytics_360", r)
        for r in ("goals_per_90min decimal(10,4)", "height int", "peak_market_value bigint", "performance_score decimal(10,2)")
    ),
    *_fits(),
    _unique("profile", "player_analytics_360", "player_id"),
    _unique("performances", "player_performances", "player_id,season_name", "WARNING"),
    _rule("profile", "player_analytics_360", "references(player_id)", "player_id NOT IN (SELECT player_id FROM profiles)"),
    _size("risk", "injury_risk_scores", 30_000, 35_000),
    _size("deals", "transfer_intelligence", 1, 10**12),
    _size("safe", "vw_high_value_low_risk_players", 1, None),
)

ORACLE: dict[str, str] = {name: statement(sql) for name, sql in _Q.items()}
