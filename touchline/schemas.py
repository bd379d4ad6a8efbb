"""Table schemas, declared keys and the fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


#: Parsed live event. ``player_name`` travels on the wire but is not read.
EVENT_SCHEMA = StructType(
    _strings("match_id")
    + [StructField("timestamp", DoubleType())]
    + _strings("team", "player_id", "event_type")
    + [StructField("x_coord", DoubleType()), StructField("y_coord", DoubleType())]
)

TEAM_STATS_SCHEMA = StructType(
    _strings("match_id", "team") + [StructField("total_events", LongType())]
)

#: Team stats as logged by the stream: the window is kept so that the keyed
#: view can order writes by event time and not by arrival.
TEAM_WINDOW_SCHEMA = StructType(
    _strings("match_id", "team")
    + [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("total_events", LongType()),
    ]
)

MATCH_CONFIG_SCHEMA = StructType(
    _strings("team_a_id", "team_a_name", "team_b_id", "team_b_name", "match_session_id")
)

#: Key of each serving table; a later write replaces an earlier one.
SERVING_KEYS = {
    "live_events": ("match_id", "timestamp"),
    "live_team_stats": ("match_id", "team"),
}


@dataclass(frozen=True)
class WarehouseTable:
    """A warehouse table: schema, storage order, key and source column names."""

    name: str
    schema: StructType
    sort_key: tuple[str, ...]
    rename: dict[str, str]
    id_columns: tuple[str, ...]
    key: tuple[str, ...] | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


FACTS = WarehouseTable(
    name="wyscout_events",
    schema=StructType(
        _strings(
            "match_id", "event_id", "event_name", "sub_event_name", "player_id", "team_id"
        )
        + [
            StructField(name, FloatType())
            for name in ("event_sec", "x_start", "y_start", "x_end", "y_end")
        ]
    ),
    sort_key=("match_id", "event_name", "player_id"),
    rename={
        "matchId": "match_id",
        "eventId": "event_id",
        "eventName": "event_name",
        "subEventName": "sub_event_name",
        "playerId": "player_id",
        "teamId": "team_id",
        "eventSec": "event_sec",
    },
    id_columns=("match_id", "event_id", "player_id", "team_id"),
)

PLAYERS = WarehouseTable(
    name="players",
    schema=StructType(
        _strings(
            "player_id",
            "short_name",
            "first_name",
            "last_name",
            "foot",
            "birth_date",
            "currentTeamId",
        )
    ),
    sort_key=("player_id",),
    rename={
        "wyId": "player_id",
        "shortName": "short_name",
        "firstName": "first_name",
        "lastName": "last_name",
        "birthDate": "birth_date",
    },
    id_columns=("player_id", "currentTeamId"),
    key=("player_id",),
)

TEAMS = WarehouseTable(
    name="teams",
    schema=StructType(_strings("team_id", "name", "official_name", "city", "type")),
    sort_key=("team_id",),
    rename={"wyId": "team_id", "officialName": "official_name"},
    id_columns=("team_id",),
    key=("team_id",),
)

MATCHES = WarehouseTable(
    name="matches",
    schema=StructType(
        _strings("match_id", "label", "dateutc", "competition_id", "season_id")
        + [StructField("gameweek", IntegerType())]
    ),
    sort_key=("match_id",),
    rename={"wyId": "match_id", "competitionId": "competition_id", "seasonId": "season_id"},
    id_columns=("match_id", "competition_id", "season_id"),
    key=("match_id",),
)

WAREHOUSE = {table.name: table for table in (FACTS, PLAYERS, TEAMS, MATCHES)}

#: Dictionaries of codes, loaded like dimensions.
EVENT_NAMES = WarehouseTable(
    name="event_names",
    schema=StructType(_strings("event", "subevent", "event_label", "subevent_label")),
    sort_key=("event", "subevent"),
    rename={},
    id_columns=("event", "subevent"),
    key=("event", "subevent"),
)

TAGS = WarehouseTable(
    name="tags",
    schema=StructType(_strings("tag", "label", "description")),
    sort_key=("tag",),
    rename={"Tag": "tag", "Label": "label", "Description": "description"},
    id_columns=("tag",),
    key=("tag",),
)

COMPETITIONS = WarehouseTable(
    name="competitions",
    schema=StructType(_strings("competition_id", "name", "format", "type")),
    sort_key=("competition_id",),
    rename={"wyId": "competition_id"},
    id_columns=("competition_id",),
    key=("competition_id",),
)

DICTIONARIES = {table.name: table for table in (EVENT_NAMES, TAGS, COMPETITIONS)}

# --- Fixed values: they must equal the source data model for equal results ----

#: Texts a CSV reader takes for a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

#: Base positions (x, y) of the 11 line-up slots: goalkeeper, defence,
#: midfield, attack.
FORMATION_A = (
    (5, 50),
    (25, 20),
    (25, 40),
    (25, 60),
    (25, 80),
    (50, 30),
    (50, 50),
    (50, 70),
    (75, 30),
    (75, 50),
    (75, 70),
)
FORMATION_B = (
    (95, 50),
    (75, 20),
    (75, 40),
    (75, 60),
    (75, 80),
    (50, 30),
    (50, 50),
    (50, 70),
    (25, 30),
    (25, 50),
    (25, 70),
)

SQUAD_SIZE = 11
DEFAULT_SESSION = "FC26_FINAL_01"
FALLBACK_EVENTS_PER_MATCH = 1450
RECENT_LIMIT = 1000
ACTION_LIMIT = 100
FEED_LIMIT = 6
LIVE_TOPIC = "live_events"

WINDOW_WIDTH = "60 seconds"
WINDOW_SLIDE = "10 seconds"
WATERMARK_DELAY = "10 seconds"

MARKERS = {"pass": "o", "shot": "*", "interception": "D", "foul": "X"}
DEFAULT_MARKER = "o"
MARKER_SIZES = {"shot": 400}
DEFAULT_MARKER_SIZE = 120
COLOUR_A = "#3b82f6"
COLOUR_B = "#ef4444"
DEFAULT_COLOUR = "yellow"
GLOW_A = "#60a5fa"
GLOW_OTHER = "#f87171"
LABEL_LENGTH = 10
LABEL_OFFSET = 3.5
