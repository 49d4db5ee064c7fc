import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("matchlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


BALL_DDL = (
    "ball_id string, match_id string, season int, innings int, over int, ball int, batting_team string, "
    "bowling_team string, batsman string, non_striker string, bowler string, runs_scored int, extras int, "
    "extras_type string, is_wicket boolean, dismissal_type string, phase string"
)


def ball(ball_id, runs=0, match="M0", innings=1, over=0, ball=0, bat="LAK", bowl="BAY", batsman="A", bowler="Z",
         extras=0, kind="none", out=False, how="none", season=2024):
    phase = "powerplay" if over < 6 else "middle" if over < 16 else "death"
    return (ball_id, match, season, innings, over, ball, bat, bowl, batsman, "N", bowler, runs, extras, kind, out,
            how, phase)


@pytest.fixture(scope="session")
def make_balls(spark):
    return lambda rows: spark.createDataFrame(rows, BALL_DDL)


def match_row(i, **over):
    row = {
        "match_id": f"M{i}", "season": 2024, "match_number": i, "date": "2024-03-30", "venue": "North Oval",
        "city": "Alba", "team1": "LAK", "team2": "BAY", "toss_winner": "LAK", "toss_decision": "bat",
        "first_batting": "LAK", "second_batting": "BAY", "innings1_runs": 180, "innings1_wickets": 5,
        "innings1_overs": 20.0, "innings2_runs": 170, "innings2_wickets": 8, "innings2_overs": 20.0,
        "winner": "LAK", "result_type": "runs", "margin": "10 runs", "player_of_match": "A", "umpire1": "U1",
        "umpire2": "U2",
    }
    return row | over


@pytest.fixture(scope="session")
def make_matches(spark):
    from matchlake.schemas import MATCHES

    def make(rows):
        return spark.createDataFrame([[r[f] for f in MATCHES.fieldNames()] for r in rows], MATCHES)

    return make


RAW_MATCHES, RAW_BALLS = 5, 6


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory):
    """Five JSON-lines files as the ingestion step receives them."""
    root = tmp_path_factory.mktemp("raw")
    squad = [
        {"player_id": f"S{i:02d}", "player_name": name, "nationality": land, "date_of_birth": f"199{i}-0{i + 1}-11",
         "batting_style": "Left", "bowling_style": "Left-arm spin", "role": "All-rounder", "ipl_debut_year": 2016 + i}
        for i, (name, land) in enumerate(
            [("Ada Voss", "Alba"), ("Bo Lind", "Norrland"), ("Cy Okoro", "Alba"), ("Di Marsh", "Southey"),
             ("Ed Quill", "Norrland"), ("Flo Pike", "Alba"), ("Gus Thorn", "Southey")]
        )
    ]
    hits = [1, 6, 0, 4, 2, 3]
    deliveries = [
        {"ball_id": f"D-{i}", "match_id": "M0", "season": 2024, "innings": 1, "over": 0, "ball": i,
         "batting_team": "LAK", "bowling_team": "BAY", "batsman": "Ada Voss", "non_striker": "Bo Lind",
         "bowler": "Cy Okoro", "runs_scored": hit, "extras": 0, "extras_type": None, "is_wicket": False,
         "dismissal_type": None, "is_boundary": hit in (4, 6), "is_six": hit == 6, "is_four": hit == 4,
         "total_runs": sum(hits[: i + 1]), "total_wickets": 0, "phase": "powerplay"}
        for i, hit in enumerate(hits[:RAW_BALLS])
    ]
    files = {
        "matches.json": [match_row(i) for i in range(RAW_MATCHES)],
        "players.json": squad,
        "ball_by_ball.json": deliveries,
        "teams.json": [{"team_id": "H-1", "team_name": "LAK", "home_venue": "North Oval", "home_city": "Alba",
                        "titles_won": 2, "first_season": 2011}],
        "venues.json": [{"venue_id": "G-7", "name": "North Oval", "city": "Alba", "country": "Albany",
                         "capacity": 18500}],
    }
    for name, rows in files.items():
        (root / name).write_text("\n".join(map(json.dumps, rows)))
    return str(root)
