"""Lake aggregates over silver tables. Dot balls follow the lake rule (no runs off the bat)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators import lines


def batting_performance(balls: DataFrame) -> DataFrame:
    keys = ["season", "match_id", "batsman"]
    counts = ("runs", "balls_faced", "fours", "sixes", "boundaries", "dot_balls")
    per_team = lines.batting_line(balls, [*keys, "batting_team"]).select(*keys, "batting_team", *counts)
    merged = lines.one_text(per_team, keys, "batting_team")
    runs, faced = F.col("runs"), F.col("balls_faced")
    return merged.select(
        "season",
        "match_id",
        F.col("batsman").alias("player_name"),
        "runs",
        "balls_faced",
        "fours",
        "sixes",
        "dot_balls",
        F.col("batting_team").alias("team"),
        m.strike_rate(runs, faced).alias("strike_rate"),
        m.percent(F.col("boundaries"), faced).alias("boundary_percentage"),
    )


def bowling_performance(balls: DataFrame) -> DataFrame:
    keys = ["season", "match_id", "bowler"]
    counts = ("runs_conceded", "balls_bowled", "wickets", "dot_balls")
    per_team = lines.bowling_line(balls, [*keys, "bowling_team"]).select(*keys, "bowling_team", *counts)
    merged = lines.one_text(per_team, keys, "bowling_team")
    runs, bowled = F.col("runs_conceded"), F.col("balls_bowled")
    return merged.select(
        "season",
        "match_id",
        F.col("bowler").alias("player_name"),
        "runs_conceded",
        "balls_bowled",
        "wickets",
        F.col("dot_balls").alias("dot_balls_bowled"),
        "bowling_team",
        m.economy(runs, bowled).alias("economy_rate"),
        m.overs_from_balls(bowled).alias("overs_bowled"),
    )


def match_summary(matches: DataFrame) -> DataFrame:
    margin = F.col("margin_value")
    return matches.withColumns(
        {
            "run_rate_diff": F.col("innings1_run_rate") - F.col("innings2_run_rate"),
            "match_competitiveness": F.when(margin <= 10, "close").when(margin <= 30, "moderate").otherwise("dominant"),
            "is_last_ball_finish": m.is_true(
                (F.col("result_type") == "wickets") & (F.col("innings2_overs") >= F.lit(19.4))
            ),
        }
    )


def team_statistics(matches: DataFrame) -> DataFrame:
    """Season table per team, with the published two-sided averages and the weighted ones."""
    return lines.team_line(matches, ["season", "team"]).select(
        "season",
        "team",
        "matches_played",
        "wins",
        "avg_runs_scored",
        "avg_run_rate",
        "batting_avg_runs",
        "batting_avg_run_rate",
        "win_percentage",
        "losses",
    )


def venue_analytics(matches: DataFrame) -> DataFrame:
    return lines.venue_line(matches, ["venue", "city"]).select(
        "venue",
        "city",
        "matches_hosted",
        "avg_total_runs",
        "avg_first_innings",
        "avg_second_innings",
        "bat_first_wins",
        "chase_wins",
        "undecided",
        "avg_run_rate",
        "bat_first_win_pct",
        "chase_win_pct",
    )


def toss_analysis(matches: DataFrame) -> DataFrame:
    return lines.toss_line(matches, ["venue", "toss_decision"])


def phase_analysis(balls: DataFrame) -> DataFrame:
    return lines.phase_line(balls, ["season", "batting_team", "phase"])
