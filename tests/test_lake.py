"""Silver, staging and gold on hand-made rows, edge cases included."""

import datetime

import pytest
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators import gold, lines, silver, staging

from .conftest import ball, match_row


def six_fours():
    return [ball(f"B{i}", 4, ball=i) for i in range(6)]


def test_six_ball_fixture(make_balls):
    balls = make_balls(six_fours())
    bat = gold.batting_performance(balls).first()
    assert (bat.runs, bat.balls_faced, bat.strike_rate, bat.fours, bat.dot_balls, bat.team) == (24, 6, 400.0, 6, 0, "LAK")
    bowl = gold.bowling_performance(balls).first()
    assert (bowl.runs_conceded, bowl.overs_bowled, bowl.economy_rate, bowl.bowling_team) == (24, 1.0, 24.0, "BAY")


def test_two_dot_rules(make_balls):
    balls = make_balls([ball("B0", 0, extras=1, kind="wide"), ball("B1", 0, ball=1), ball("B2", 1, ball=2)])
    count = lambda rule: lines.batting_line(balls, ["batsman"], rule).first().dot_balls
    assert (count("bat"), count("all")) == (2, 1)
    with pytest.raises(ValueError):
        m.is_dot("other")


def test_run_outs_can_be_excluded(make_balls):
    balls = make_balls([ball("B0", out=True, how="run out"), ball("B1", ball=1, out=True, how="bowled")])
    assert lines.bowling_line(balls, ["bowler"]).first().wickets == 2
    assert lines.bowling_line(balls, ["bowler"], exclude_run_outs=True).first().wickets == 1


def test_economy_definitions_differ(make_balls):
    balls = make_balls([ball(f"B{i}", 1, ball=i % 6, over=i // 6) for i in range(8)])
    row = lines.bowling_line(balls, ["bowler"]).first()
    # Eight balls are 1.3 overs when rounded first: 8 / 1.3 = 6.15 against 6.0 per six balls.
    assert (row.economy_rate, row.economy_of_rounded_overs, row.overs_bowled) == (6.0, 6.15, 1.3)


def test_silver_matches_edges(make_matches):
    raw = make_matches(
        [
            match_row(0, innings2_overs=0.0),
            match_row(1, innings2_overs=None),
            match_row(2, margin="tie", winner=None, result_type="tie"),
            match_row(3, margin=""),
            match_row(4, margin=None, date="not a date"),
            match_row(5, match_id=None),
            match_row(6, innings1_runs=200, innings2_runs=151),
        ]
    )
    rows = {r.match_id: r for r in silver.silver_matches(raw).collect()}
    assert len(rows) == 6
    assert rows["M0"].innings2_run_rate is None and rows["M1"].innings2_run_rate is None
    assert rows["M0"].innings1_run_rate == 9.0
    assert [rows[f"M{i}"].margin_value for i in range(5)] == [10, 10, None, None, None]
    assert rows["M2"].toss_winner_is_match_winner is False and rows["M2"].batting_first_won is False
    assert rows["M4"].date is None and rows["M0"].date == datetime.date(2024, 3, 30)
    assert rows["M0"].is_high_scoring is False and rows["M6"].is_high_scoring is True
    assert "_processed_timestamp" in rows["M0"].asDict()


def test_dedupe_keeps_newest_whatever_the_partitioning(make_matches):
    old = make_matches([match_row(0, margin="1 run")]).withColumn("_ingestion_timestamp", F.lit("2024-01-01").cast("timestamp"))
    new = make_matches([match_row(0, margin="2 runs")]).withColumn("_ingestion_timestamp", F.lit("2024-01-02").cast("timestamp"))
    for parts in (1, 5):
        kept = silver.silver_matches(old.unionByName(new).repartition(parts)).collect()
        assert [r.margin for r in kept] == ["2 runs"]
        assert "_ingestion_timestamp" not in kept[0].asDict()
    same = make_matches([match_row(0, margin="1 run"), match_row(0, margin="2 runs")])
    first = {silver.dedupe_latest(same.repartition(n)).first().margin for n in (1, 2, 5)}
    assert len(first) == 1


def test_silver_balls(make_balls):
    row = silver.silver_balls(make_balls([ball("B0", 6, over=3, ball=2)])).first()
    assert (row.over_ball, row.ball_number, row.is_six, row.is_boundary, row.is_four) == ("3.2", 21, True, True, False)


def test_staging_uses_warehouse_rules(make_balls, make_matches):
    stg = staging.stg_ball_events(make_balls([ball("B0", 0, extras=1, over=16)])).first()
    assert (stg.is_dot_ball, stg.match_phase, stg.over_number) == (False, "death", 16)
    match = staging.stg_matches(make_matches([match_row(0, innings1_runs=12, innings1_overs=19.2, innings2_overs=0.0)])).first()
    # 12 / 19.2 is exactly 0.625 and rounds half away from zero.
    assert str(match.innings1_run_rate) == "0.63" and match.innings2_run_rate is None
    assert str(match.innings1_overs) == "19.2"


def test_match_summary_labels(make_matches):
    rows = [
        match_row(0, margin="10 runs"),
        match_row(1, margin="30 runs"),
        match_row(2, margin="31 runs"),
        match_row(3, margin="tie", winner=None, result_type="tie"),
        match_row(4, margin="2 wickets", result_type="wickets", innings2_overs=19.4),
        match_row(5, margin="2 wickets", result_type="wickets", innings2_overs=19.3),
    ]
    out = {r.match_id: r for r in gold.match_summary(silver.match_columns(make_matches(rows))).collect()}
    labels = [out[f"M{i}"].match_competitiveness for i in range(4)]
    assert labels == ["close", "moderate", "dominant", "dominant"]
    assert [out[f"M{i}"].is_last_ball_finish for i in (0, 4, 5)] == [False, True, False]


def test_team_statistics_definitions(make_matches):
    """LAK: innings slot 1 scores 180 and 100 as first-named, slot 2 scores 170 as second-named; in
    M1 the second-named side batted first."""
    rows = [
        match_row(0),
        match_row(1, innings1_runs=100, innings2_runs=90, first_batting="BAY", second_batting="LAK", winner="BAY"),
        match_row(2, team1="BAY", team2="LAK", first_batting="BAY", second_batting="LAK", winner=None, result_type="tie"),
    ]
    mi = gold.team_statistics(silver.match_columns(make_matches(rows))).where("team = 'LAK'").first()
    assert (mi.matches_played, mi.wins, mi.losses, mi.win_percentage) == (3, 1, 2, 33.33)
    assert mi.avg_runs_scored == ((180 + 100) / 2 + 170) / 2
    assert mi.batting_avg_runs == pytest.approx((180 + 90 + 170) / 3)


def test_venue_and_toss(make_matches):
    rows = [
        match_row(0),
        match_row(1, winner="BAY", result_type="wickets", margin="3 wickets"),
        match_row(2, winner=None, result_type="tie", margin="tie", city="Abbey"),
    ]
    matches = silver.match_columns(make_matches(rows))
    venues = {r.city: r for r in gold.venue_analytics(matches).collect()}
    assert (venues["Alba"].bat_first_wins, venues["Alba"].chase_wins, venues["Alba"].undecided) == (1, 1, 0)
    # An undecided match counts as a chase in the published split.
    assert (venues["Abbey"].chase_wins, venues["Abbey"].undecided) == (1, 1)
    merged = lines.venue_line(matches, ["venue"]).first()
    assert (merged.city, merged.matches_hosted, merged.bat_first_wins) == ("Abbey", 3, 1)
    toss = gold.toss_analysis(matches).first()
    assert (toss.total_matches, toss.toss_winner_won, toss.toss_advantage_pct) == (3, 1, 33.33)


def test_phase_totals_add_up(make_balls):
    rows = [ball(f"B{i}", i % 7, over=i % 20, ball=i % 6) for i in range(200)]
    balls = make_balls(rows)
    phases = gold.phase_analysis(balls).collect()
    assert {p.phase for p in phases} == {"powerplay", "middle", "death"}
    assert sum(p.total_runs for p in phases) == sum(r[11] for r in rows)
    assert sum(p.total_balls for p in phases) == 200


def test_empty_tables(make_balls, make_matches):
    balls, matches = make_balls([]), silver.match_columns(make_matches([]))
    for df in (
        gold.batting_performance(balls),
        gold.phase_analysis(balls),
        gold.team_statistics(matches),
        gold.venue_analytics(matches),
    ):
        assert df.count() == 0
