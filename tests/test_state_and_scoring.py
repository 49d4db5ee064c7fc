"""Running state, results and scoring formulas against hand-computed and brute-force values."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from matchlake.functions import scoring
from matchlake.operators import state

from .conftest import ball


def random_match(match, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.choice(["none"] * 8 + ["wide", "noball"])
        rows.append(
            ball(f"{match}-{i:05d}", rng.choice([0, 1, 2, 4, 6]), match=match, innings=rng.choice([1, 2]),
                 over=rng.randrange(20), ball=rng.randrange(6), extras=int(kind != "none"), kind=kind,
                 out=rng.random() < 0.02)
        )
    return rows


def brute_force(rows):
    out = {}
    firsts = {}
    for r in rows:
        if r[3] == 1:
            firsts[r[1]] = firsts.get(r[1], 0) + r[11] + r[12]
    key = lambda r: (r[1], r[3])
    for (match, innings), group in itertools.groupby(sorted(rows, key=lambda r: (r[1], r[3], r[4], r[5], r[0])), key):
        runs = wickets = legal = 0
        for r in group:
            runs += r[11] + r[12]
            wickets += r[14]
            legal += r[13] == "none"
            out[r[0]] = (runs, wickets, legal, firsts.get(match, 0) + 1 if innings == 2 else None)
    return out


@pytest.mark.parametrize("split", [1, 2])
def test_running_state_equals_brute_force_with_a_hot_match(make_balls, split):
    """One match holds half of all rows, some matches have a single innings."""
    rows = random_match("HOT", 3000, 1) + [b for i in range(30) for b in random_match(f"M{i}", 100, i)]
    rows += [ball("X1", 4, match="ONLY2", innings=2), ball("X2", 4, match="ONLY1", innings=1)]
    got = state.running_state(make_balls(rows).repartition(7), split)
    values = {r.ball_id: (r.total_runs, r.total_wickets, r.legal_balls, r.target) for r in got.collect()}
    assert values == brute_force(rows)
    last = got.groupBy("match_id", "innings").agg(F.max("total_runs").alias("n"))
    sums = {(r[1], r[3]): 0 for r in rows}
    for r in rows:
        sums[r[1], r[3]] += r[11] + r[12]
    assert {(r.match_id, r.innings): r.n for r in last.collect()} == sums


def test_rates_and_labels(make_balls):
    rows = [
        ball("A0", 4),
        ball("A1", 2, ball=1),
        ball("A2", 0, over=19, ball=5),
        ball("B0", 1, innings=2, bat="BAY", bowl="LAK"),
        ball("B1", 0, innings=2, bat="BAY", bowl="LAK", ball=0, kind="wide", extras=1),
        ball("B2", 6, innings=2, bat="BAY", bowl="LAK", ball=1),
    ]
    df = state.with_match_state(state.with_chase(state.with_run_rate(state.running_state(make_balls(rows)))))
    got = {r.ball_id: r for r in df.collect()}
    # No over bowled yet: the rate is taken over a tenth of an over.
    assert got["A0"].run_rate == 40.0 and got["A1"].run_rate == 36.0
    assert got["A2"].match_state == "innings_break" and got["A1"].match_state == "in_progress"
    assert (got["B0"].target, got["B0"].runs_needed, got["B0"].balls_remaining) == (7, 6, 120)
    assert got["B0"].required_rate == 0.3
    assert got["A0"].runs_needed is None and got["A0"].required_rate is None
    assert got["B1"].match_state == "in_progress" and got["B2"].match_state == "completed"
    assert got["B2"].runs_needed == 0


def test_deliveries_with_unknown_over_are_kept(make_balls):
    rows = [ball("B0", 4), ball("B1", 2), ball("B2", 6)]
    rows[1] = (*rows[1][:4], None, *rows[1][5:])
    got = {r.ball_id: r.total_runs for r in state.running_state(make_balls(rows)).collect()}
    # Unknown overs sort first, as in a plain window over the innings.
    assert got == {"B1": 2, "B0": 6, "B2": 12}


def test_all_out_ends_an_innings(make_balls):
    rows = [ball(f"B{i}", 0, over=i // 6, ball=i % 6, out=True) for i in range(10)]
    labels = state.with_match_state(state.running_state(make_balls(rows))).orderBy("ball_id").collect()
    assert [r.match_state for r in labels] == ["in_progress"] * 9 + ["innings_break"]


def test_extras_split(make_balls):
    rows = [ball("B0", 0, extras=1, kind="wide"), ball("B1", 4, extras=1, kind="noball"), ball("B2", 1)]
    got = {r.ball_id: r for r in state.with_extras_split(make_balls(rows)).collect()}
    assert [(got[b].is_legal, got[b].bat_runs, got[b].wide_runs, got[b].noball_runs) for b in ("B0", "B1", "B2")] == [
        (False, 0, 1, 0), (False, 4, 0, 1), (True, 1, 0, 0)]


@pytest.mark.parametrize(
    "second, rule, winner, margin",
    [
        (7, "defending", "BAY", "10 wickets"),
        (5, "defending", "LAK", "1 runs"),
        (6, "defending", "LAK", "0 runs"),
        (6, "undecided", None, "tie"),
    ],
)
def test_match_summary_from_events(make_balls, second, rule, winner, margin):
    rows = [ball("A0", 4), ball("A1", 2, ball=1)]
    rows += [ball(f"B{i}", 1, innings=2, ball=i, bat="BAY", bowl="LAK") for i in range(second - 4)]
    rows += [ball("B9", 4, innings=2, ball=5, bat="BAY", bowl="LAK"), ball("B8", 0, innings=2, ball=5, bat="BAY", bowl="LAK")]
    row = state.summarise_match(make_balls(rows), rule).first()
    assert (row.winner, row.margin) == (winner, margin)
    assert (row.innings1_team, row.innings2_team, row.total_fours) == ("LAK", "BAY", 2)


def test_summary_without_second_innings(make_balls):
    row = state.summarise_match(make_balls([ball("A0", 4)])).first()
    assert (row.winner, row.margin, row.innings2_team, row.innings2_runs) == ("LAK", "4 runs", None, 0)


def test_totals_from_feed_agree_with_sums(spark, make_balls):
    rows = random_match("M0", 300, 5)
    feed = state.running_state(make_balls(rows)).withColumnRenamed("ball_id", "event_id")
    totals = {(r.match_id, r.innings): (r.runs, r.wickets) for r in state.match_totals_from_feed(feed).collect()}
    result = state.match_results(make_balls(rows)).first()
    assert totals["M0", 1] == (result.runs_1, result.wickets_1)
    assert totals["M0", 2] == (result.runs_2, result.wickets_2)


def chase(spark, *rows):
    states = spark.createDataFrame(rows, "target int, score int, wickets int, overs double")
    return scoring.with_chase_probability(states).collect()


def expected_chase(target, score, wickets, overs):
    need, balls = target - score, max(1, int((20 - overs) * 6))
    rate = (score / max(1, overs * 6) * 6) / max(0.1, need / balls * 6)
    hand = (10 - wickets) / 10
    p = 0.6 / (1 + math.exp(-2 * (rate - 1))) + 0.3 * balls / 120 * hand + 0.1 * hand
    p *= 0.4 if wickets >= 8 else 0.7 if wickets >= 6 else 1
    return min(0.99, max(0.01, 1.0 if need <= 0 else p))


def test_chase_probability(spark):
    cases = [(180, 100, 3, 12.0), (150, 145, 1, 18.0), (200, 50, 7, 15.0), (150, 150, 9, 20.0), (150, 10, 9, 19.0), (1, 0, 0, 0.0)]
    rows = chase(spark, *cases)
    for row, case in zip(rows, cases):
        assert row.batting_win_probability == pytest.approx(expected_chase(*case), abs=6e-5)
        assert row.batting_win_probability + row.bowling_win_probability == pytest.approx(1)
    assert rows[1].batting_win_probability > 0.5 > rows[2].batting_win_probability
    assert rows[3].batting_win_probability == 0.99
    assert (rows[0].runs_needed, rows[0].balls_remaining, rows[0].wickets_in_hand) == (80, 48, 7)


def test_out_of_domain_states_are_set_aside(spark):
    rows = [(180, 100, 3, 12.0), (0, 1, 1, 1.0), (180, -1, 1, 1.0), (180, 1, 11, 1.0), (180, 1, 1, 20.1), (None, 1, 1, 1.0)]
    states = spark.createDataFrame(rows, "target int, score int, wickets int, overs double")
    good, bad = scoring.quarantine(states)
    assert (good.count(), bad.count()) == (1, 5)


def test_first_innings_projection(spark):
    states = spark.createDataFrame([(0, 0, 0.0), (60, 1, 6.0), (150, 9, 18.0)], "score int, wickets int, overs double")
    rows = scoring.with_first_innings_probability(states).collect()
    assert [r.projected_total for r in rows] == [165, round(60 + 10 * 14 * 1.15 * 0.92), round(150 + 150 / 18 * 2 * 1.05 * 0.5)]
    assert rows[0].batting_win_probability == 0.5


def test_mixed_states(spark):
    rows = [(180, 100, 3, 12.0, True), (180, 60, 1, 6.0, False)]
    states = spark.createDataFrame(rows, "target int, score int, wickets int, overs double, is_chasing boolean")
    chase, first = scoring.with_win_probability(states).collect()
    assert chase.batting_win_probability == pytest.approx(expected_chase(180, 100, 3, 12.0), abs=6e-5)
    assert chase.projected_total is None and chase.balls_remaining == 48
    assert (first.projected_total, first.runs_needed) == (208, None)
    assert first.batting_win_probability == pytest.approx(0.5 + (60 + 140 * 1.15 * 0.92 - 165) * 0.008 - 0.03, abs=6e-5)


FANTASY = "runs int, balls_faced int, fours int, sixes int, wickets int, overs_bowled double, runs_conceded int, catches int, run_outs int"


@pytest.mark.parametrize(
    "line, batting, bowling, fielding",
    [
        ((50, 35, 5, 2, 1, 4.0, 28, 1, 0), 86, 27, 8),
        ((0, 1, 0, 0, 0, 0.0, 0, 0, 0), -2, 0, 0),
        ((0, 0, 0, 0, 0, 0.0, 0, 0, 1), 0, 0, 12),
        ((6, 12, 0, 0, 0, 1.0, 30, 0, 0), 6 - 6, 0, 0),
        ((8, 12, 0, 0, 0, 2.0, 24, 0, 0), 8 - 4, -6, 0),
        ((100, 50, 0, 0, 5, 4.0, 16, 0, 0), 100 + 25 + 50 + 6, 125 + 25 + 50 + 6, 0),
        ((15, 10, 0, 0, 3, 4.0, 44, 0, 0), 15 + 4, 75 + 25 - 4, 0),
        ((1, 9, 0, 0, 0, 4.0, 24, 0, 0), 1, 4, 0),
    ],
)
def test_full_fantasy(spark, line, batting, bowling, fielding):
    row = spark.createDataFrame([line], FANTASY).withColumns(scoring.fantasy_points()).first()
    assert (row.batting_points, row.bowling_points, row.fielding_points) == (batting, bowling, fielding)
    assert row.total_fantasy_points == batting + bowling + fielding


def test_pressure(spark):
    rows = [(50, 30, 5), (10, 0, 1), (10, 100, 10), (60, 40, 5)]
    states = spark.createDataFrame(rows, "runs_needed int, balls_remaining int, wickets_in_hand int")
    got = scoring.with_pressure(states).collect()
    assert (got[0].pressure_index, got[0].assessment, got[0].required_rate) == (69.6, "high", 10.0)
    assert (got[1].required_rate, got[1].assessment) == (999.0, "extreme")
    assert got[2].assessment == "low"


def test_live_indicators(spark):
    rows = [(100, 3, 8.33, 180), (200, 3, 8.0, 180), (100, 3, 8.33, None)]
    states = spark.createDataFrame(rows, "total_runs int, total_wickets int, run_rate double, target int")
    got = scoring.live_indicators(states).collect()
    assert [(r.score_line, r.runs_needed, r.projected) for r in got] == [
        ("100/3", 80, None), ("200/3", 0, None), ("100/3", None, 166)]


def test_extras_inside_the_runs(make_balls):
    """The same deliveries in both conventions, and without an extras column."""
    apart = make_balls([ball("B0", 4), ball("B1", 0, ball=1, extras=1, kind="wide"), ball("B2", 2, ball=2, extras=1, kind="noball")])
    inside = make_balls([ball("B0", 4), ball("B1", 1, ball=1, extras=1, kind="wide"), ball("B2", 3, ball=2, extras=1, kind="noball")])
    columns = ["ball_id", "bat_runs", "wide_runs", "noball_runs", "is_legal"]
    want = sorted(map(str, state.with_extras_split(apart).select(*columns).collect()))
    assert sorted(map(str, state.with_extras_split(inside, extras_inside=True).select(*columns).collect())) == want
    totals = lambda df, **k: {r.ball_id: r.total_runs for r in state.running_state(df, **k).collect()}
    assert totals(apart) == totals(inside, extras_inside=True) == {"B0": 4, "B1": 5, "B2": 8}
    bare = state.with_extras_split(inside.drop("extras"), extras_inside=True).select(*columns)
    assert sorted(map(str, bare.collect())) == want
