"""Declared schemas. Input is never inferred, so a malformed file cannot change a table's types.

Field names and types are fixed values: they are the published input formats.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructType,
)

STRING, INT, DOUBLE, BOOLEAN = StringType(), IntegerType(), DoubleType(), BooleanType()


def _struct(*fields: tuple[str, DataType]) -> StructType:
    schema = StructType()
    for names, kind in fields:
        for name in names.split():
            schema.add(name, kind)
    return schema


MATCHES = _struct(
    ("match_id", STRING),
    ("season match_number", INT),
    ("date venue city team1 team2 toss_winner toss_decision first_batting second_batting", STRING),
    ("innings1_runs innings1_wickets", INT),
    ("innings1_overs", DOUBLE),
    ("innings2_runs innings2_wickets", INT),
    ("innings2_overs", DOUBLE),
    ("winner result_type margin player_of_match umpire1 umpire2", STRING),
)

BALL_EVENTS = _struct(
    ("ball_id match_id", STRING),
    ("season innings over ball", INT),
    ("batting_team bowling_team batsman non_striker bowler", STRING),
    ("runs_scored extras", INT),
    ("extras_type", STRING),
    ("is_wicket", BOOLEAN),
    ("dismissal_type", STRING),
    ("is_boundary is_six is_four", BOOLEAN),
    ("total_runs total_wickets", INT),
    ("phase", STRING),
)

PLAYERS = _struct(
    ("player_id player_name nationality date_of_birth batting_style bowling_style role", STRING),
    ("ipl_debut_year", INT),
)

TEAMS = _struct(
    ("team_id team_name home_venue home_city", STRING),
    ("titles_won first_season", INT),
)

VENUES = _struct(
    ("venue_id name city country", STRING),
    ("capacity", INT),
)

LIVE_BALL_EVENT = _struct(
    ("event_id match_id timestamp", STRING),
    ("innings over ball", INT),
    ("batting_team bowling_team batsman bowler", STRING),
    ("runs_scored", INT),
    ("is_wicket", BOOLEAN),
    ("dismissal_type", STRING),
    ("is_boundary", BOOLEAN),
    ("total_runs total_wickets", INT),
    ("run_rate", DOUBLE),
    ("is_powerplay is_death_overs", BOOLEAN),
    ("phase venue city match_state", STRING),
)

SCORE_UPDATE = _struct(
    ("match_id timestamp", STRING),
    ("innings over ball total_runs total_wickets", INT),
    ("run_rate", DOUBLE),
    ("batting_team bowling_team", STRING),
)

_TOSS = _struct(("winner decision", STRING))
_INFO = _struct(
    ("teams", ArrayType(STRING)),
    ("gender match_type season", STRING),
    ("dates", ArrayType(STRING)),
    ("venue city", STRING),
    ("toss", _TOSS),
    ("outcome", MapType(STRING, STRING)),
    ("player_of_match umpires", ArrayType(STRING)),
)
_DELIVERY = _struct(
    ("batsman bowler non_striker", STRING),
    ("runs", _struct(("batsman extras total", INT))),
    ("extras", MapType(STRING, INT)),
    ("wickets", ArrayType(_struct(("kind player_out", STRING)))),
)
_INNINGS = _struct(("deliveries", ArrayType(MapType(STRING, _DELIVERY))))

MATCH_DOCUMENT = _struct(("info", _INFO), ("innings", ArrayType(MapType(STRING, _INNINGS))))

METADATA_COLUMNS = ("_ingestion_timestamp", "_source", "_ingestion_date", "_batch_id")
