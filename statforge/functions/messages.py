"""Message schemas, and how each message becomes flat rows.

The same functions serve batch files and streams: they take any DataFrame with a text ``value``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statforge.functions import expr as E

_NAMED_AREA = "STRUCT<id: INT, name: STRING, code: STRING, flag: STRING>"
_SEASON = (
    "STRUCT<id: INT, startDate: STRING, endDate: STRING, currentMatchday: INT, winner: STRUCT<id: INT, name: STRING>>"
)
_TEAM = "STRUCT<id: INT, name: STRING, shortName: STRING, tla: STRING, crest: STRING>"
_GOALS = "STRUCT<home: INT, away: INT>"
_TEXT_MAP = "MAP<STRING, STRING>"
_TABLE_ROW = (
    f"STRUCT<position: INT, team: {_TEAM}, playedGames: INT, form: STRING, won: INT, draw: INT, lost: INT, "
    "points: INT, goalsFor: INT, goalsAgainst: INT, goalDifference: INT>"
)

# Fixed formats: field names and types of the messages.
MATCH = (
    "id BIGINT, utcDate STRING, status STRING, matchday INT, stage STRING, lastUpdated STRING, "
    f"area {_TEXT_MAP}, competition {_TEXT_MAP}, season {_TEXT_MAP}, homeTeam {_TEXT_MAP}, awayTeam {_TEXT_MAP}, "
    f"score STRUCT<winner: STRING, duration: STRING, fullTime: {_GOALS}, halfTime: {_GOALS}>, "
    f"referees ARRAY<{_TEXT_MAP}>, odds {_TEXT_MAP}"
)
COMPETITION = (
    "id INT, name STRING, code STRING, type STRING, emblem STRING, plan STRING, "
    f"area {_NAMED_AREA}, currentSeason {_SEASON}, numberOfAvailableSeasons INT, lastUpdated STRING"
)
STANDINGS = (
    f"filters {_TEXT_MAP}, area {_NAMED_AREA}, "
    "competition STRUCT<id: INT, name: STRING, code: STRING, type: STRING, emblem: STRING>, "
    f"season {_SEASON}, "
    f"standings ARRAY<STRUCT<stage: STRING, type: STRING, `group`: STRING, `table`: ARRAY<{_TABLE_ROW}>>>"
)
# As above, but with table rows as text by key: only so an explicit null differs from an absent key.
STANDINGS_FILE = STANDINGS.replace(_TABLE_ROW, _TEXT_MAP)
COMPETITIONS_FILE = f"competitions ARRAY<STRUCT<{COMPETITION}>>"


@dataclass(frozen=True)
class Flat:
    """One flat column: where it comes from, what to make of it, what to use when it is missing."""

    name: str
    path: str
    kind: str = "as_is"
    default: object = None

    def column(self, root: str, zone: str | None) -> Column:
        col = F.col(f"{root}{self.path}")
        if self.kind == "int":
            col = E.lenient_int(col)
        elif self.kind == "date":
            col = E.lenient_date(col)
        elif self.kind == "utc":
            col = E.iso_utc(col)
        elif self.kind == "local":
            col = E.iso_utc(col) if zone is None else E.in_zone(E.iso_utc(col), zone)
        elif self.kind == "json":
            col = F.to_json(col)
        if self.default is not None:
            col = F.coalesce(col, F.lit(self.default))
        return col.alias(self.name)



# Layout of the flat rows.
MATCH_LAYOUT = (
    Flat("match_id", "id"),
    Flat("utc_date", "utcDate", "local"),
    Flat("last_updated", "lastUpdated", "local"),
    Flat("status", "status"),
    Flat("matchday", "matchday", default=0),
    Flat("stage", "stage", default="UNKNOWN"),
    Flat("area_id", "area.id", "int"),
    Flat("area_name", "area.name"),
    Flat("area_code", "area.code"),
    Flat("competition_id", "competition.id", "int"),
    Flat("competition_name", "competition.name"),
    Flat("competition_code", "competition.code"),
    Flat("season_id", "season.id", "int"),
    Flat("season_start_date", "season.startDate", "date"),
    Flat("season_end_date", "season.endDate", "date"),
    Flat("home_team_id", "homeTeam.id", "int"),
    Flat("home_team_name", "homeTeam.name"),
    Flat("home_team_short_name", "homeTeam.shortName"),
    Flat("home_team_tla", "homeTeam.tla"),
    Flat("away_team_id", "awayTeam.id", "int"),
    Flat("away_team_name", "awayTeam.name"),
    Flat("away_team_short_name", "awayTeam.shortName"),
    Flat("away_team_tla", "awayTeam.tla"),
    Flat("winner", "score.winner", default="DRAW"),
    Flat("duration", "score.duration", default="REGULAR"),
    Flat("ft_home_goals", "score.fullTime.home", default=0),
    Flat("ft_away_goals", "score.fullTime.away", default=0),
    Flat("ht_home_goals", "score.halfTime.home", default=0),
    Flat("ht_away_goals", "score.halfTime.away", default=0),
    Flat("area_details", "area", "json"),
    Flat("competition_details", "competition", "json"),
    Flat("season_details", "season", "json"),
    Flat("home_team_details", "homeTeam", "json"),
    Flat("away_team_details", "awayTeam", "json"),
    Flat("score_details", "score", "json"),
    Flat("referees", "referees", "json"),
)
COMPETITION_LAYOUT = (
    Flat("competition_id", "id"),
    Flat("competition_name", "name"),
    Flat("competition_code", "code"),
    Flat("competition_type", "type"),
    Flat("emblem_url", "emblem"),
    Flat("plan", "plan"),
    Flat("area_id", "area.id"),
    Flat("area_name", "area.name"),
    Flat("area_code", "area.code"),
    Flat("area_flag_url", "area.flag"),
    Flat("current_season_id", "currentSeason.id"),
    Flat("season_start_date", "currentSeason.startDate", "date"),
    Flat("season_end_date", "currentSeason.endDate", "date"),
    Flat("current_matchday", "currentSeason.currentMatchday", default=0),
    Flat("season_winner_id", "currentSeason.winner.id"),
    Flat("season_winner_name", "currentSeason.winner.name"),
    Flat("number_of_available_seasons", "numberOfAvailableSeasons", default=0),
    Flat("last_updated", "lastUpdated", "utc"),
)
STANDING_LAYOUT = (
    Flat("competition_id", "competition.id"),
    Flat("competition_name", "competition.name"),
    Flat("competition_code", "competition.code"),
    Flat("competition_type", "competition.type"),
    Flat("season_id", "season.id"),
    Flat("season_start_date", "season.startDate", "date"),
    Flat("season_end_date", "season.endDate", "date"),
    Flat("current_matchday", "season.currentMatchday", default=0),
    Flat("area_id", "area.id"),
    Flat("area_name", "area.name"),
    Flat("area_code", "area.code"),
    Flat("stage", "standing.stage", default="REGULAR_SEASON"),
    Flat("standing_type", "standing.type", default="TOTAL"),
    Flat("group_name", "standing.group"),
    Flat("position", "entry.position"),
    Flat("team_id", "entry.team.id"),
    Flat("team_name", "entry.team.name"),
    Flat("team_short_name", "entry.team.shortName"),
    Flat("team_tla", "entry.team.tla"),
    Flat("team_crest_url", "entry.team.crest"),
    Flat("played_games", "entry.playedGames", default=0),
    Flat("won", "entry.won", default=0),
    Flat("draw", "entry.draw", default=0),
    Flat("lost", "entry.lost", default=0),
    Flat("points", "entry.points", default=0),
    Flat("goals_for", "entry.goalsFor", default=0),
    Flat("goals_against", "entry.goalsAgainst", default=0),
    Flat("goal_difference", "entry.goalDifference", default=0),
    Flat("form", "entry.form"),
)

# Columns a row must have to be kept, and the zone match times are shown in.
MATCH_REQUIRED = ("match_id", "utc_date", "status")
COMPETITION_REQUIRED = ("competition_id", "competition_name")
STANDING_REQUIRED = ("competition_id", "season_id", "team_id")
MATCH_ZONE = "Asia/Ho_Chi_Minh"


def parse(messages: DataFrame, schema: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``raw_json`` text and its parsed ``data``; broken text gives an all-NULL ``data``.

    ``carry`` names columns of the message source (offset, timestamp) to keep. The one-element explode
    makes Spark parse a message once; as a plain column the parser would be copied into every field
    that is read from ``data``.
    """
    raw = F.col("value").cast("string")
    once = F.explode(F.array(F.from_json(raw, schema)))
    return messages.select(raw.alias("raw_json"), once.alias("data"), *carry)


def unreadable(parsed: DataFrame, probe: str = "id") -> DataFrame:
    """Messages whose identifying field could not be read, for counting or quarantine."""
    return parsed.where(F.col(f"data.{probe}").isNull()).select("raw_json")


def _required(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.dropna(subset=list(names))


def flatten_match(
    parsed: DataFrame, zone: str | None = MATCH_ZONE, carry: tuple[str, ...] = (), audit: bool = True
) -> DataFrame:
    """One row per match message, times shifted to ``zone``; the raw text is kept."""
    stamp = [F.current_timestamp().alias("processing_ts")] if audit else []
    columns = [flat.column("data.", zone) for flat in MATCH_LAYOUT]
    return _required(parsed.select(*columns, F.col("raw_json").alias("raw"), *stamp, *carry), MATCH_REQUIRED)


def flatten_competition(parsed: DataFrame, carry: tuple[str, ...] = (), audit: bool = True) -> DataFrame:
    """One row per competition message."""
    stamp = [F.current_timestamp().alias("processed_at")] if audit else []
    columns = [flat.column("data.", None) for flat in COMPETITION_LAYOUT]
    return _required(parsed.select(*columns, *stamp, *carry), COMPETITION_REQUIRED)


# Statistics that are 0 where their key is absent.
_STATISTICS = ("playedGames", "won", "draw", "lost", "points", "goalsFor", "goalsAgainst", "goalDifference")
STATISTIC_COLUMNS = ("played_games", "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_difference")


def typed_standings(standings: Column) -> Column:
    """``STANDINGS_FILE`` tables with typed rows: an absent statistic is 0, an explicit null stays NULL."""

    def typed(row: Column) -> Column:
        numbers = [F.when(F.map_contains_key(row, F.lit(k)), row[k].try_cast("int")).otherwise(0).alias(k) for k in _STATISTICS]
        return F.struct(row["position"].try_cast("int").alias("position"), F.from_json(row["team"], _TEAM).alias("team"), row["form"].alias("form"), *numbers)

    return F.transform(standings, lambda standing: standing.withField("table", F.transform(standing["table"], typed)))


def flatten_standings(
    parsed: DataFrame,
    carry: tuple[str, ...] = (),
    audit: bool = True,
    keep_null: tuple[str, ...] = (),
    required: tuple[str, ...] = STANDING_REQUIRED,
) -> DataFrame:
    """One row per team of every table of a standings message; empty or missing tables give none.

    Columns in ``keep_null`` take no default.
    """
    head = ("competition", "season", "area")
    tables = parsed.select(*(f"data.{h}" for h in head), F.explode("data.standings").alias("standing"), *carry)
    entries = tables.select(
        *head,
        F.col("standing").dropFields("table").alias("standing"),
        F.explode("standing.table").alias("entry"),
        *carry,
    )
    stamp = [F.current_timestamp().alias("processed_at")] if audit else []
    layout = (replace(flat, default=None) if flat.name in keep_null else flat for flat in STANDING_LAYOUT)
    columns = [flat.column("", None) for flat in layout]
    return _required(entries.select(*columns, *stamp, *carry), required)
