"""Warehouse staging: renames, casts and the warehouse's own derivations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m


def _loaded_at(df: DataFrame) -> Column:
    """Ingestion time travels with the row, so a high-water filter sees only rows that are new."""
    source = "_ingestion_timestamp"
    return (F.col(source) if source in df.columns else F.current_timestamp()).alias("_loaded_at")


def _ints(*names: str) -> list[Column]:
    return [F.col(c).try_cast("int").alias(c) for c in names]


def stg_ball_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ball_id",
        "match_id",
        *_ints("season", "innings"),
        F.col("over").try_cast("int").alias("over_number"),
        F.col("ball").try_cast("int").alias("ball_number_in_over"),
        "batting_team",
        "bowling_team",
        "batsman",
        "non_striker",
        "bowler",
        *_ints("runs_scored", "extras"),
        "extras_type",
        F.col("is_wicket").try_cast("boolean").alias("is_wicket"),
        "dismissal_type",
        m.ball_number().try_cast("int").alias("ball_number"),
        m.is_dot("all").alias("is_dot_ball"),
        m.is_boundary().alias("is_boundary"),
        m.is_four().alias("is_four"),
        m.is_six().alias("is_six"),
        m.phase().alias("match_phase"),
        _loaded_at(raw),
    )


def stg_matches(raw: DataFrame) -> DataFrame:
    overs = lambda n: F.col(f"innings{n}_overs").try_cast("decimal(4,1)")
    rate = lambda n: F.round(
        F.col(f"innings{n}_runs") / F.nullif(overs(n), F.lit(0).cast("decimal(4,1)")), 2
    ).cast("decimal(10,2)")
    return raw.select(
        "match_id",
        *_ints("season", "match_number"),
        F.try_to_date(F.col("date").cast("string"), "yyyy-MM-dd").alias("match_date"),
        "venue",
        "city",
        "team1",
        "team2",
        "toss_winner",
        "toss_decision",
        "first_batting",
        "second_batting",
        *_ints("innings1_runs", "innings1_wickets"),
        overs(1).alias("innings1_overs"),
        *_ints("innings2_runs", "innings2_wickets"),
        overs(2).alias("innings2_overs"),
        "winner",
        "result_type",
        "margin",
        "player_of_match",
        "umpire1",
        "umpire2",
        (F.col("innings1_runs") + F.col("innings2_runs")).alias("total_match_runs"),
        m.same(F.col("toss_winner"), F.col("winner")).alias("toss_winner_won_match"),
        m.is_true(F.col("result_type") == "runs").alias("batting_first_won"),
        rate(1).alias("innings1_run_rate"),
        rate(2).alias("innings2_run_rate"),
        _loaded_at(raw),
    )


def stg_players(raw: DataFrame) -> DataFrame:
    return raw.select(
        "player_id",
        "player_name",
        "nationality",
        F.try_to_date(F.col("date_of_birth").cast("string"), "yyyy-MM-dd").alias("date_of_birth"),
        "batting_style",
        "bowling_style",
        F.col("role").alias("player_role"),
        *_ints("ipl_debut_year"),
        _loaded_at(raw),
    )
