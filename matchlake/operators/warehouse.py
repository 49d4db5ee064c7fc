"""Star schema over staging tables. Dot balls follow the warehouse rule (no runs and no extras)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.functions import scoring
from matchlake.operators import lines
from matchlake.operators.ranking import with_ordinal

BALL_FACT = (
    "ball_id match_id season innings over_number ball_number_in_over ball_number batting_team "
    "bowling_team batsman non_striker bowler runs_scored extras extras_type is_wicket "
    "dismissal_type is_dot_ball is_boundary is_four is_six match_phase _loaded_at"
).split()

MATCH_FACT = (
    "match_id season match_number match_date venue city team1 team2 toss_winner toss_decision "
    "first_batting second_batting innings1_runs innings1_wickets innings1_overs innings1_run_rate "
    "innings2_runs innings2_wickets innings2_overs innings2_run_rate winner result_type margin "
    "player_of_match total_match_runs toss_winner_won_match batting_first_won"
).split()

CAREER = (
    "matches_played total_runs total_balls_faced total_fours total_sixes highest_score batting_average "
    "career_strike_rate fifties centuries total_wickets career_economy best_bowling_figures"
).split()

PLAYER_COUNTS = (
    "runs balls_faced fours sixes dismissals was_dismissed runs_conceded balls_bowled wickets bowling_dot_balls "
    "season _loaded_at"
).split()

MATCH_DIM = (
    "match_id season match_number match_date venue city team1 team2 toss_winner toss_decision "
    "first_batting second_batting winner result_type margin player_of_match umpire1 umpire2 "
    "total_match_runs toss_winner_won_match batting_first_won innings1_run_rate innings2_run_rate"
).split()


def batting_stats(stg_balls: DataFrame) -> DataFrame:
    keys = ["season", "match_id", "batsman", "batting_team", "innings"]
    return lines.batting_line(stg_balls, keys, "all").select(
        "season",
        "match_id",
        F.col("batsman").alias("player_name"),
        F.col("batting_team").alias("team"),
        "innings",
        "runs",
        "balls_faced",
        "fours",
        "sixes",
        "dot_balls",
        "boundaries",
        "was_dismissed",
        "strike_rate",
    )


def bowling_stats(stg_balls: DataFrame) -> DataFrame:
    keys = ["season", "match_id", "bowler", "bowling_team", "innings"]
    return lines.bowling_line(stg_balls, keys, "all").select(
        "season",
        "match_id",
        F.col("bowler").alias("player_name"),
        F.col("bowling_team").alias("team"),
        "innings",
        "runs_conceded",
        "balls_bowled",
        "wickets",
        "dot_balls",
        "overs_bowled",
        F.col("economy_of_rounded_overs").alias("economy_rate"),
    )


def dim_player(stg_players: DataFrame, stg_balls: DataFrame) -> DataFrame:
    """Career line per registered player; zeros where a player never batted or bowled.

    Averages run over innings lines, so both roles are first taken to that grain in one pass.
    """
    grain = ["season", "match_id", "innings", "player", "team", "role"]
    innings = (
        lines.roles(stg_balls)
        .groupBy(*grain)
        .agg(
            F.sum("runs_scored").alias("runs"),
            F.count("*").alias("balls"),
            m.count_where(m.is_four()).alias("fours"),
            m.count_where(m.is_six()).alias("sixes"),
            m.count_where(m.is_out()).alias("wickets"),
        )
        .withColumn("economy", m.economy_of_rounded_overs(F.col("runs"), F.col("balls")))
    )
    bat, bowl = F.col("role") == lines.BAT, F.col("role") == lines.BOWL
    of = lambda role, c: F.when(role, F.col(c))
    career = (
        innings.groupBy(F.col("player").alias("player_name"))
        .agg(
            F.countDistinct(of(bat, "match_id")).alias("matches_played"),
            F.sum(of(bat, "runs")).alias("total_runs"),
            F.sum(of(bat, "balls")).alias("total_balls_faced"),
            F.sum(of(bat, "fours")).alias("total_fours"),
            F.sum(of(bat, "sixes")).alias("total_sixes"),
            F.max(of(bat, "runs")).alias("highest_score"),
            m.int_avg(of(bat, "runs"), 2).alias("batting_average"),
            m.count_where(of(bat, "runs") >= 50).alias("fifties"),
            m.count_where(of(bat, "runs") >= 100).alias("centuries"),
            F.sum(of(bowl, "wickets")).alias("total_wickets"),
            m.exact_avg(of(bowl, "economy"), 2).alias("career_economy"),
            F.max(of(bowl, "wickets")).alias("best_bowling_figures"),
        )
        .withColumn("career_strike_rate", m.strike_rate(F.col("total_runs"), F.col("total_balls_faced")))
    )
    return stg_players.join(career, "player_name", "left").select(
        "player_id",
        "player_name",
        "nationality",
        "date_of_birth",
        "batting_style",
        "bowling_style",
        "player_role",
        "ipl_debut_year",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in CAREER],
    )


def team_record(stg_matches: DataFrame) -> DataFrame:
    """dim_team without its surrogate id."""
    agg = (
        lines.sides(stg_matches)
        .groupBy(F.col("team").alias("team_name"))
        .agg(
            F.count("*").alias("total_matches"),
            m.count_where(F.col("winner") == F.col("team")).alias("total_wins"),
            F.min("season").alias("first_season"),
            F.max("season").alias("last_season"),
            F.countDistinct("season").alias("seasons_played"),
        )
    )
    return agg.select(
        "team_name",
        "total_matches",
        "total_wins",
        (F.col("total_matches") - F.col("total_wins")).alias("total_losses"),
        m.percent(F.col("total_wins"), F.col("total_matches")).alias("win_percentage"),
        "first_season",
        "last_season",
        "seasons_played",
    )


def dim_team(stg_matches: DataFrame) -> DataFrame:
    return with_ordinal(team_record(stg_matches), [F.col("team_name")], "team_id", F.left("team_name", F.lit(3)))


def dim_venue(stg_matches: DataFrame, country: str = "India") -> DataFrame:
    shaped = stg_matches.withColumn("total_runs", F.col("total_match_runs"))
    one_dp = lambda c: F.round(F.col(c), 1)
    venues = lines.venue_line(shaped, ["venue", "city"]).select(
        F.col("venue").alias("venue_name"),
        "city",
        F.lit(country).alias("country"),
        "matches_hosted",
        one_dp("avg_total_runs").alias("avg_match_total"),
        one_dp("avg_first_innings").alias("avg_first_innings_score"),
        one_dp("avg_second_innings").alias("avg_second_innings_score"),
        "bat_first_wins",
        "chase_wins",
        "bat_first_win_pct",
        F.round(F.lit(100) - F.col("bat_first_win_pct"), 2).alias("chase_win_pct"),
        "avg_first_innings_rr",
        "avg_second_innings_rr",
        F.col("first_season").alias("first_match_season"),
        F.col("last_season").alias("last_match_season"),
    )
    return with_ordinal(venues, [F.col("venue_name"), F.col("city")], "venue_id", F.left("venue_name", F.lit(3)))


def dim_match(stg_matches: DataFrame) -> DataFrame:
    total = F.col("total_match_runs")
    category = (
        F.when(total > 400, "very_high_scoring")
        .when(total > 350, "high_scoring")
        .when(total > 300, "moderate")
        .when(total > 250, "low_scoring")
        .otherwise("very_low_scoring")
    )
    return stg_matches.select(*MATCH_DIM, category.alias("scoring_category"))


def fact_ball_events(stg_balls: DataFrame) -> DataFrame:
    return stg_balls.select(*BALL_FACT)


def fact_match_summary(stg_matches: DataFrame, stg_balls: DataFrame) -> DataFrame:
    in_phase = lambda p: F.col("match_phase") == p
    phases = {"powerplay": "powerplay", "middle": "middle_overs", "death": "death_overs"}
    pivot = []
    for phase, name in phases.items():
        pivot.append(F.sum(F.when(in_phase(phase), F.col("runs_scored")).otherwise(0)).alias(f"{name}_runs"))
        pivot.append(m.count_where(in_phase(phase) & m.is_out()).alias(f"{name}_wickets"))
    totals = stg_balls.groupBy("match_id").agg(
        m.count_where(m.is_four()).alias("total_fours"),
        m.count_where(m.is_six()).alias("total_sixes"),
        m.count_where(m.is_dot("all")).alias("total_dot_balls"),
        *pivot,
    )
    return stg_matches.join(totals, "match_id", "left").select(
        *MATCH_FACT,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in totals.columns[1:]],
        "_loaded_at",
    )


def fact_player_performance(stg_balls: DataFrame, exclude_run_outs: bool = False) -> DataFrame:
    """One row per (match, player), batting and bowling side by side.

    The grain is the merge key, so a player appearing in two innings neither fans out nor breaks it.
    """
    keys = ["match_id", "player"]
    per_team = lines.player_line(stg_balls, [*keys, "team"], "all", exclude_run_outs).select(*keys, "team", *PLAYER_COUNTS)
    merged = lines.one_text(per_team, keys, "team", prefer=F.col("balls_faced") > 0)
    return lines.with_player_rates(merged).select(
        "season",
        "match_id",
        F.col("player").alias("player_name"),
        "team",
        F.col("runs").alias("batting_runs"),
        "balls_faced",
        "fours",
        "sixes",
        "strike_rate",
        "was_dismissed",
        "wickets",
        "runs_conceded",
        "overs_bowled",
        F.col("economy_of_rounded_overs").alias("economy_rate"),
        "bowling_dot_balls",
        scoring.simple_fantasy_points().alias("fantasy_points"),
        "_loaded_at",
    )
