"""Star schema, incremental merge, history, ranking and serving."""


import pytest
from pyspark.sql import functions as F

from matchlake.operators import incremental, insights, serving, silver, staging, warehouse
from matchlake.operators.ranking import latest_per_key, page, total, with_ordinal
from matchlake.plans import registry
from matchlake.sources import versions
from matchlake.sources.io import read_table, write_table

from .conftest import TESTDATA, ball, match_row


def stg(make_balls, rows):
    return staging.stg_ball_events(make_balls(rows))


def test_two_innings_player_is_one_performance_row(make_balls):
    rows = [
        ball("B0", 4, batsman="A", bowler="Z"),
        ball("B1", 6, batsman="A", bowler="Z", innings=2, bat="BAY", bowl="LAK"),
        ball("B2", 1, batsman="Z", bowler="A", innings=2, bat="BAY", bowl="LAK", out=True),
        ball("B3", 0, batsman="K", bowler="Z", extras=1, kind="wide"),
    ]
    fact = warehouse.fact_player_performance(stg(make_balls, rows))
    got = {r.player_name: r for r in fact.collect()}
    assert set(got) == {"A", "Z", "K"}
    a = got["A"]
    assert (a.batting_runs, a.balls_faced, a.fours, a.sixes, a.wickets, a.was_dismissed) == (10, 2, 1, 1, 1, 0)
    assert a.fantasy_points == 10 + 1 + 2 + 25
    # Z never batted for MI: the team of the deliveries Z faced comes first.
    assert (got["Z"].team, got["Z"].bowling_dot_balls, got["Z"].was_dismissed) == ("BAY", 0, 1)
    assert (got["K"].wickets, got["K"].overs_bowled, got["K"].economy_rate) == (0, 0.0, 0.0)


def test_dim_player_keeps_players_without_deliveries(spark, make_balls):
    players = spark.createDataFrame(
        [("P1", "A", "India", "1990-01-01", "Right", "None", "Batsman", 2010), ("P2", "Nobody", "India", "bad", "Left", "None", "Bowler", 2011)],
        "player_id string, player_name string, nationality string, date_of_birth string, batting_style string, "
        "bowling_style string, role string, ipl_debut_year int",
    )
    rows = [ball(f"B{i}", 6, over=i // 6, ball=i % 6) for i in range(9)] + [ball("C0", 0, match="M1")]
    got = {r.player_name: r for r in warehouse.dim_player(staging.stg_players(players), stg(make_balls, rows)).collect()}
    a, none = got["A"], got["Nobody"]
    assert (a.matches_played, a.total_runs, a.highest_score, a.batting_average, a.fifties) == (2, 54, 54, 27.0, 1)
    assert (none.total_runs, none.batting_average, none.total_wickets, none.date_of_birth) == (0, 0.0, 0, None)


def test_dim_team_and_venue_ids(make_matches):
    matches = staging.stg_matches(make_matches([match_row(0), match_row(1, team1="VAL", venue="Mill Lane", season=2023)]))
    teams = {r.team_name: r for r in warehouse.dim_team(matches).collect()}
    assert {n: r.team_id for n, r in teams.items()} == {"BAY": 1, "LAK": 2, "VAL": 3}
    assert (teams["BAY"].first_season, teams["BAY"].last_season, teams["BAY"].seasons_played) == (2023, 2024, 2)
    venues = {r.venue_name: r.venue_id for r in warehouse.dim_venue(matches).collect()}
    assert venues == {"Mill Lane": 1, "North Oval": 2}


def test_match_fact_fills_matches_without_deliveries(make_matches, make_balls):
    matches = staging.stg_matches(make_matches([match_row(0), match_row(1, innings1_runs=230, innings2_runs=180)]))
    rows = [ball("B0", 4), ball("B1", 6, over=17, out=True), ball("B2", 0, over=8)]
    got = {r.match_id: r for r in warehouse.fact_match_summary(matches, stg(make_balls, rows)).collect()}
    assert (got["M0"].powerplay_runs, got["M0"].death_overs_runs, got["M0"].death_overs_wickets) == (4, 6, 1)
    assert (got["M1"].total_fours, got["M1"].middle_overs_runs) == (0, 0)
    labels = {r.match_id: r.scoring_category for r in warehouse.dim_match(matches).collect()}
    assert labels == {"M0": "moderate", "M1": "very_high_scoring"}


DELTA = "k string, season int, v int, at int"


def test_merge_rows_takes_the_newest(spark):
    target = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 2, 1)], DELTA)
    delta = spark.createDataFrame([("b", 1, 3, 2), ("b", 1, 4, 3), ("c", 1, 5, 2)], DELTA)
    merged = incremental.merge_rows(target, delta, ["k"], "at")
    assert sorted((r.k, r.v) for r in merged.collect()) == [("a", 1), ("b", 4), ("c", 5)]


def held(spark, path):
    return sorted((r.k, r.season or 0, r.v) for r in read_table(spark, path).collect())


def files_of(path, part):
    return {p.name: p.stat().st_mtime_ns for p in path.glob(f"data/*/_part={part}/*.parquet")}


def test_upsert_is_idempotent_and_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 1), ("x", None, 9, 1)], DELTA)
    assert incremental.upsert_table(first, path, ["k"], "at", "season") == 3
    untouched = files_of(tmp_path / "t", 1)
    delta = spark.createDataFrame([("b", 2, 3, 2), ("c", 2, 4, 2), ("x", None, 8, 2)], DELTA)
    for _ in range(2):
        incremental.upsert_table(delta, path, ["k"], "at", "season")
        assert held(spark, path) == [("a", 1, 1), ("b", 2, 3), ("c", 2, 4), ("x", 0, 8)]
    assert untouched and files_of(tmp_path / "t", 1) == untouched
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_moved_keys_and_older_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.upsert_table(spark.createDataFrame([("a", 1, 1, 5), ("b", 1, 2, 5)], DELTA), path, ["k"], "at", "season")
    incremental.upsert_table(spark.createDataFrame([("a", 2, 7, 6)], DELTA), path, ["k"], "at", "season")
    assert held(spark, path) == [("a", 2, 7), ("b", 1, 2)]
    older = spark.createDataFrame([("b", 1, 0, 4)], DELTA)
    assert incremental.upsert_table(older, path, ["k"], "at", "season") == 0
    assert held(spark, path) == [("a", 2, 7), ("b", 1, 2)]
    incremental.upsert_table(older, path, ["k"], "at", "season", keep_newer=False)
    assert held(spark, path) == [("a", 2, 7), ("b", 1, 0)]


@pytest.mark.parametrize("partition_by", [None, "season"])
@pytest.mark.parametrize("step", ["write_files", "commit", "_clean"])
def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch, partition_by, step):
    """Stopped before each step, and inside the first write of a new table, then run again."""
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 2, 1)], DELTA)
    delta = spark.createDataFrame([("b", 2, 3, 2), ("c", 3, 4, 2)], DELTA)
    before = None
    for rows, after in ((first, [("a", 1, 1), ("b", 2, 2)]), (delta, [("a", 1, 1), ("b", 2, 3), ("c", 3, 4)])):
        with monkeypatch.context() as patch:
            patch.setattr(versions, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                incremental.upsert_table(rows, path, ["k"], "at", partition_by)
        # Cleaning comes after the commit, so there the new version stands.
        seen = after if step == "_clean" else before
        assert incremental.table_exists(spark, path) == (seen is not None)
        if seen is not None:
            assert held(spark, path) == seen
        incremental.upsert_table(rows, path, ["k"], "at", partition_by)
        assert held(spark, path) == after
        before = after


def test_an_empty_first_write_is_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], DELTA)
    assert incremental.upsert_table(empty, path, ["k"], "at", "season") == 0
    assert incremental.table_exists(spark, path) and read_table(spark, path).schema == empty.schema
    incremental.upsert_table(spark.createDataFrame([("a", 1, 1, 1)], DELTA), path, ["k"], "at", "season")
    assert held(spark, path) == [("a", 1, 1)]


def test_high_water(spark):
    source = spark.createDataFrame([(i,) for i in range(5)], "_loaded_at int")
    assert incremental.newer_than(source, source.where("_loaded_at < 3")).count() == 2
    assert incremental.newer_than(source, source.where("false")).count() == 5


def test_history_over_three_snapshots(spark):
    def snapshot(*rows):
        return spark.createDataFrame(rows, "team_name string, total_matches int, total_wins int")

    at = lambda day: F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
    check = ["total_matches", "total_wins"]
    h = incremental.scd2(None, snapshot(("A", 1, 1), ("B", 1, 0)), "team_name", check, at(1))
    h = incremental.scd2(h, snapshot(("A", 2, 1), ("B", 1, 0), ("C", 1, None)), "team_name", check, at(2))
    h = incremental.scd2(h, snapshot(("A", 2, 1), ("C", 1, 1)), "team_name", check, at(3))
    day = lambda t: None if t is None else t.day
    rows = sorted((r.team_name, r.total_matches, r.total_wins, day(r.valid_from), day(r.valid_to)) for r in h.na.fill(-1).collect())
    assert rows == [("A", 1, 1, 1, 2), ("A", 2, 1, 2, None), ("B", 1, 0, 1, None), ("C", 1, -1, 2, 3), ("C", 1, 1, 3, None)]
    again = incremental.scd2(h, snapshot(("A", 2, 1), ("C", 1, 1)), "team_name", check, at(4))
    assert again.count() == len(rows)


def test_ordinals_and_pages(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 7919 % 5003).repartition(13)
    order, bucket = [F.col("v").desc()], F.floor(F.col("v") / 100)
    numbered = {r.id: r.n for r in with_ordinal(df, order, "n", bucket, descending=True).collect()}
    ranked = sorted(range(5000), key=lambda i: -(i * 7919 % 5003))
    assert numbered == {i: n for n, i in enumerate(ranked, 1)}
    assert [r.id for r in page(df, order, bucket, True, 3, 50).collect()] == ranked[100:150]
    assert page(df, order, bucket, True, 1000, 50).count() == 0 and total(df).first().total == 5000
    with pytest.raises(ValueError):
        page(df, [F.col("v")], bucket, False, 1, 101)
    assert with_ordinal(df.where("false"), [F.col("v")], "n", bucket).count() == 0
    nulls = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, id int")
    got = {r.id: r.n for r in with_ordinal(nulls, [F.col("k")], "n", F.left("k", F.lit(1))).collect()}
    assert got == {2: 1, 1: 2, 3: 3}


def jobs_while(spark, build):
    """Jobs that run while build() makes its frame."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        build()
        return len(tracker.getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(
    "name", ["w4_dim_team", "w5_dim_venue", "r5_head_to_head_contains", "r13_team_rankings", "i2_team_history", "r1_player_listing"]
)
def test_no_job_runs_while_a_frame_is_built(spark, name):
    registered = registry()
    name = name if name in registered else next(n for n in registered if n.startswith(name.split("_")[0] + "_"))
    registered[name].run(spark, f"{TESTDATA}/sf0.001")  # reading a file's schema is a job of its own
    before = jobs_while(spark, lambda: [spark.read.parquet(f"{TESTDATA}/sf0.001/{n}.parquet") for n in ("orders", "lineitem", "customer")])
    assert jobs_while(spark, lambda: registered[name].run(spark, f"{TESTDATA}/sf0.001")) <= 2 * max(before, 1)


def test_latest_per_key_on_a_hot_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    kept = latest_per_key(df, ["k"], [F.col("id").desc()], 3)
    assert sorted(r.id for r in kept.where("k = 0").collect()) == [19994, 19996, 19998]
    assert kept.count() == 26 * 3


@pytest.fixture()
def season(make_matches):
    rows = [
        match_row(0),
        match_row(1, date="2024-04-02", winner="BAY", result_type="wickets", margin="3 wickets"),
        match_row(2, date="2024-04-03", team1="VAL", winner=None, result_type="tie", margin="tie"),
        match_row(3, date="2023-04-03", season=2023, team2="LAK Women", winner="LAK Women", result_type="wickets"),
    ]
    return silver.match_columns(make_matches(rows))


def test_team_serving(season):
    stats = {r.team_name: r for r in serving.team_stats(season).collect()}
    assert (stats["LAK"].matches_played, stats["LAK"].wins, stats["LAK"].losses, stats["LAK"].seasons_played) == (3, 1, 2, 2)
    assert all(0 <= r.win_percentage <= 100 for r in stats.values())
    assert {r.team_name for r in serving.team_stats(season, "lak").collect()} == {"LAK", "LAK Women"}
    ranks = {r.team_name: r["rank"] for r in serving.team_rankings(season).collect()}
    assert ranks == {"LAK Women": 1, "BAY": 2, "LAK": 3, "VAL": 4}
    assert {r.team_name for r in serving.team_rankings(season, 2023).collect()} == {"LAK", "LAK Women"}


def test_head_to_head_rules(season):
    exact = serving.head_to_head(season, "LAK", "BAY", match="exact").first()
    assert (exact.meetings, exact.head_to_head_team1_wins, exact.head_to_head_team2_wins) == (2, 1, 1)
    # "lak" is part of both names in M3, so under the substring rule that match meets itself.
    loose = serving.head_to_head(season, "lak", "lak women").first()
    assert (loose.team1_name, loose.team2_name, loose.meetings) == ("LAK", "LAK Women", 1)
    unknown = serving.head_to_head(season, "LAK", "nobody").first()
    assert (unknown.team2_name, unknown.team2_matches_played, unknown.meetings) == ("nobody", 0, 0)
    with pytest.raises(ValueError):
        serving.head_to_head(season, "LAK", "BAY", match="regex")


def test_match_serving(season):
    assert [r.match_id for r in serving.get_matches(season).collect()] == ["M2", "M1", "M0", "M3"]
    assert serving.filter_matches(season, team="women").count() == 1
    assert serving.filter_matches(season, season=2024, team="val").count() == 1
    assert [r.match_id for r in serving.recent_matches(season, 1).collect()] == ["M2"]
    with pytest.raises(ValueError):
        serving.recent_matches(season, 51)
    assert serving.get_matches(season, page=2, per_page=3).count() == 1


def test_extended_season_summary(season, make_balls):
    rows = [ball("B0", 6), ball("B1", 4), ball("B2", 4)]
    got = {r.season: r for r in serving.extended_season_summary(season, make_balls(rows)).collect()}
    assert (got[2024].total_sixes, got[2024].total_fours, got[2023].total_fours) == (1, 2, 0)
    assert (got[2024].highest_team_score, got[2024].lowest_team_score) == (180, 170)


def test_qualifier_before_cut(spark, make_balls):
    players = spark.createDataFrame([(i, n, None, None) for i, n in enumerate("ABC")], "player_id int, player_name string, nationality string, role string")
    rows = [ball("A0", 6, batsman="A")] + [ball(f"B{i}", 4, batsman="B", ball=i) for i in range(5)] + [ball(f"C{i}", 1, batsman="C") for i in range(20)]
    leaders = serving.strike_rate_leaders(players, make_balls(rows), 10, 20).collect()
    assert [r.player_name for r in leaders] == ["B", "C"]
    assert leaders[0].role == "Unknown" and leaders[0].nationality == "Unknown"
    assert serving.top_bowlers(players, make_balls(rows), role=None).count() == 3


def test_insights(season, make_balls):
    kpis = insights.match_kpis(season).first()
    assert (kpis.total_matches, kpis.seasons, kpis.most_wins) == (4, 2, "BAY")
    assert insights.match_kpis(season.where("false")).first().total_matches == 0
    toss = {r.toss_decision: r.win_rate for r in insights.toss_win_rate(season).collect()}
    assert toss == {"bat": 25.0}
    seasons = {r.season: (r.total, r.wins) for r in insights.team_seasons(season, "LAK", [2024]).collect()}
    assert seasons == {2024: (2, 1)}
    assert insights.meeting_record(season, "LAK", "BAY").first().total == 2
    rows = [ball(f"B{i:02d}", i % 7, over=i // 6, ball=i % 6, out=i == 29, how="caught") for i in range(30)]
    feed = insights.recent_deliveries(make_balls(rows)).orderBy("ball_id").collect()
    assert [r.ball_id for r in feed] == [f"B{i}" for i in range(20, 30)]
    assert feed[-1].result == "WICKET! (caught)" and feed[0].result == "6 runs"
    team = insights.dream_team(make_balls(rows)).collect()
    assert {(r.role, r.player) for r in team} == {("batsman", "A"), ("bowler", "Z")}
    detail = insights.player_totals(make_balls(rows), "nobody").first()
    assert (detail.batting_runs, detail.strike_rate, detail.matches) == (0, 0.0, 0)
    names = {(r.kind, r.name) for r in insights.distinct_names(season, make_balls(rows)).collect()}
    assert ("team", "VAL") in names and ("venue", "North Oval") in names and ("batsman", "A") in names
    bins = {(r.innings, r.bin_start): r.matches for r in insights.score_distribution(season).collect()}
    assert bins == {(1, 180): 4, (2, 170): 4}


def test_write_returns_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(7).withColumn("p", F.col("id") % 2), path, partition_by=["p"]) == 7
    assert write_table(spark.range(2).withColumn("p", F.lit(1)), path, partition_by=["p"], replace_partitions=True) == 2
    assert read_table(spark, path).groupBy("p").count().orderBy("p").collect() == [(0, 4), (1, 2)]


def test_clustered_writes_keep_a_key_together(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(2000).selectExpr("id % 3 AS season", "id % 40 AS k", "id").repartition(9)
    assert write_table(df, path, partition_by=["season"], cluster_by=["k", "id"]) == 2000
    back = read_table(spark, path).withColumn("file", F.col("_metadata.file_path"))
    assert back.count() == 2000
    assert back.groupBy("season", "k").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0


def test_empty_writes_and_deltas(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], DELTA)
    assert write_table(empty, path, partition_by=["season"]) == 0
    path = str(tmp_path / "u")
    incremental.upsert_table(spark.createDataFrame([("a", 1, 1, 1)], DELTA), path, ["k"], "at", "season")
    assert incremental.upsert_table(empty, path, ["k"], "at", "season") == 0
    assert incremental.upsert_table(spark.range(5).where("id > 9").selectExpr("string(id) k", "int(id) season", "int(id) v", "int(id) at"), path, ["k"], "at", "season") == 0
    assert read_table(spark, path).count() == 1


def test_wins_and_undecided_make_all_matches(spark):
    from matchlake.plans.base import Tables

    matches = Tables(spark, f"{TESTDATA}/sf0.001").matches
    wins = serving.team_stats(matches).agg(F.sum("wins")).first()[0]
    undecided = matches.where(F.col("winner").isNull()).count()
    assert wins + undecided == matches.count()
