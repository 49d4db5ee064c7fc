"""The generic aggregations behind gold, warehouse, serving and dashboard tables.

Each returns one wide row per key. Callers select what they publish and Catalyst drops the
aggregates nobody reads, so a caller pays only for its own columns. Every aggregate combines before
the shuffle, so a hot player, team or venue costs one partial row per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m


def _loaded(balls: DataFrame) -> list[Column]:
    """Newest load time behind a row, where the input carries one."""
    return [F.max("_loaded_at").alias("_loaded_at")] if "_loaded_at" in balls.columns else []


def one_text(counts: DataFrame, keys: Sequence[str], text: str, prefer: Column | None = None) -> DataFrame:
    """Folds counts grouped by (*keys, text) to one row per key, keeping the first text by name, of
    those where `prefer` holds if any does.

    A text column inside an aggregate makes Spark sort every input row; grouping by it first hashes
    them, and only the few rows left per key are sorted here.
    """
    rest = [c for c in counts.columns if c not in {*keys, text}]
    how = {"was_dismissed": F.max, "_loaded_at": F.max, "season": F.min, "first_season": F.min, "last_season": F.max}
    first = F.min(text) if prefer is None else F.min_by(text, F.struct(~prefer, F.col(text)))
    return counts.groupBy(*keys).agg(first.alias(text), *[how.get(c, F.sum)(c).alias(c) for c in rest])


def batting_line(
    balls: DataFrame,
    keys: Sequence[str],
    dot_rule: str = "bat",
    exclude_run_outs: bool = False,
) -> DataFrame:
    out = m.is_out(exclude_run_outs)
    agg = balls.groupBy(*keys).agg(
        F.sum("runs_scored").alias("runs"),
        F.count("*").alias("balls_faced"),
        m.count_where(m.is_four()).alias("fours"),
        m.count_where(m.is_six()).alias("sixes"),
        m.count_where(m.is_boundary()).alias("boundaries"),
        m.count_where(m.is_dot(dot_rule)).alias("dot_balls"),
        m.count_where(out).alias("dismissals"),
        F.max(out.cast("int")).alias("was_dismissed"),
        F.countDistinct("match_id").alias("matches"),
    )
    runs, faced = F.col("runs"), F.col("balls_faced")
    return agg.withColumns(
        {
            "strike_rate": m.strike_rate(runs, faced),
            "boundary_percentage": m.percent(F.col("boundaries"), faced),
            "runs_per_match": m.ratio(runs, F.col("matches")),
            "runs_per_dismissal": m.ratio(runs, F.greatest(F.col("dismissals"), F.lit(1))),
        }
    )


def bowling_line(
    balls: DataFrame,
    keys: Sequence[str],
    dot_rule: str = "bat",
    exclude_run_outs: bool = False,
) -> DataFrame:
    agg = balls.groupBy(*keys).agg(
        F.sum("runs_scored").alias("runs_conceded"),
        F.count("*").alias("balls_bowled"),
        m.count_where(m.is_out(exclude_run_outs)).alias("wickets"),
        m.count_where(m.is_dot(dot_rule)).alias("dot_balls"),
        F.countDistinct("match_id").alias("matches"),
    )
    runs, bowled = F.col("runs_conceded"), F.col("balls_bowled")
    return agg.withColumns(
        {
            "overs_bowled": m.overs_from_balls(bowled),
            "economy_rate": m.economy(runs, bowled),
            "economy_of_rounded_overs": m.economy_of_rounded_overs(runs, bowled),
        }
    )


BAT, BOWL = "bat", "bowl"


def roles(balls: DataFrame) -> DataFrame:
    """Two rows per delivery, one for the striker and one for the bowler, from a single scan."""
    player = lambda role, name, team: F.struct(
        F.lit(role).alias("role"), F.col(name).alias("player"), F.col(team).alias("team")
    )
    kept = (
        "season match_id innings runs_scored extras is_wicket dismissal_type phase match_phase _loaded_at"
    ).split()
    both = F.array(player(BAT, "batsman", "batting_team"), player(BOWL, "bowler", "bowling_team"))
    return balls.select(*[c for c in kept if c in balls.columns], F.inline(both))


def player_line(
    balls: DataFrame, keys: Sequence[str], dot_rule: str = "bat", exclude_run_outs: bool = False
) -> DataFrame:
    """Batting and bowling of a player side by side; keys name `player`, not batsman or bowler.

    Grouping both roles together replaces a full outer join of two aggregates: one scan and one
    shuffle, and a player with a single role simply has zeros for the other.
    """
    bat, bowl = F.col("role") == BAT, F.col("role") == BOWL
    total = lambda role, value: F.sum(F.when(role, value).otherwise(0))
    out = m.is_out(exclude_run_outs)
    run_out = m.is_out() & (F.col("dismissal_type") == "run out")
    agg = (
        roles(balls)
        .groupBy(*keys)
        .agg(
            total(bat, F.col("runs_scored")).alias("runs"),
            m.count_where(bat).alias("balls_faced"),
            m.count_where(bat & m.is_four()).alias("fours"),
            m.count_where(bat & m.is_six()).alias("sixes"),
            m.count_where(bat & out).alias("dismissals"),
            F.max(F.when(bat & out, 1).otherwise(0)).alias("was_dismissed"),
            F.countDistinct(F.when(bat, F.col("match_id"))).alias("matches"),
            total(bowl, F.col("runs_scored")).alias("runs_conceded"),
            m.count_where(bowl).alias("balls_bowled"),
            m.count_where(bowl & out).alias("wickets"),
            m.count_where(bowl & m.is_dot(dot_rule)).alias("bowling_dot_balls"),
            m.count_where(bowl & out & (F.col("dismissal_type") == "caught")).alias("caught_off"),
            m.count_where(bowl & run_out).alias("run_out_off"),
            *([F.min("season").alias("season")] if "season" not in keys else []),
            *_loaded(balls),
        )
    )
    return with_player_rates(agg)


def with_player_rates(agg: DataFrame) -> DataFrame:
    runs, faced = F.col("runs"), F.col("balls_faced")
    conceded, bowled = F.col("runs_conceded"), F.col("balls_bowled")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return agg.withColumns(
        {
            "strike_rate": zero(m.strike_rate(runs, faced)),
            "runs_per_dismissal": m.ratio(runs, F.greatest(F.col("dismissals"), F.lit(1))),
            "overs_bowled": m.overs_from_balls(bowled),
            "economy_rate": zero(m.economy(conceded, bowled)),
            "economy_of_rounded_overs": zero(m.economy_of_rounded_overs(conceded, bowled)),
        }
    )


def phase_line(balls: DataFrame, keys: Sequence[str], dot_rule: str = "bat") -> DataFrame:
    agg = balls.groupBy(*keys).agg(
        F.sum("runs_scored").alias("total_runs"),
        F.count("*").alias("total_balls"),
        m.count_where(m.is_out()).alias("wickets"),
        m.count_where(m.is_boundary()).alias("boundaries"),
        m.count_where(m.is_dot(dot_rule)).alias("dot_balls"),
    )
    total = F.col("total_balls")
    return agg.withColumns(
        {
            "run_rate": m.economy(F.col("total_runs"), total),
            "boundary_pct": m.percent(F.col("boundaries"), total),
            "dot_ball_pct": m.percent(F.col("dot_balls"), total),
        }
    )


def sides(matches: DataFrame) -> DataFrame:
    """Two rows per match, one per side, from a single scan.

    slot_* carry the score of the listed innings number (side 1 with innings 1), batted_* the score
    of the innings this side batted in; the two differ when the second-named side bats first.
    """
    batted = lambda team, c: F.when(F.col("first_batting") == team, F.col(f"innings1_{c}")).otherwise(
        F.col(f"innings2_{c}")
    )

    def side(n: int):
        team, other = F.col(f"team{n}"), F.col(f"team{3 - n}")
        return F.struct(
            F.lit(n).alias("side"),
            team.alias("team"),
            other.alias("opponent"),
            F.col(f"innings{n}_runs").alias("slot_runs"),
            F.col(f"innings{n}_run_rate").alias("slot_run_rate"),
            batted(team, "runs").alias("batted_runs"),
            batted(team, "run_rate").alias("batted_run_rate"),
        )

    kept = [c for c in ("match_id", "season", "winner", "toss_winner", "toss_decision", "date") if c in matches.columns]
    return matches.select(*kept, F.inline(F.array(side(1), side(2))))


def team_line(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Played, won and scoring per team. avg_* average the two sides' averages; batting_avg_*
    weigh every innings the team actually batted in."""
    per_side = (
        sides(matches)
        .groupBy(*keys, "side")
        .agg(
            F.count("*").alias("matches_played"),
            m.count_where(F.col("winner") == F.col("team")).alias("wins"),
            m.int_avg(F.col("slot_runs")).alias("avg_runs"),
            m.exact_avg(F.col("slot_run_rate")).alias("avg_rate"),
            F.sum("batted_runs").alias("batted_runs"),
            F.count("batted_runs").alias("batted_innings"),
            F.sum(F.col("batted_run_rate").cast("decimal(18,2)")).alias("batted_rates"),
            F.count("batted_run_rate").alias("rated_innings"),
        )
    )
    agg = per_side.groupBy(*keys).agg(
        F.sum("matches_played").alias("matches_played"),
        F.sum("wins").alias("wins"),
        F.avg("avg_runs").alias("avg_runs_scored"),
        F.avg("avg_rate").alias("avg_run_rate"),
        m.ratio(F.sum("batted_runs"), F.sum("batted_innings"), None).alias("batting_avg_runs"),
        m.ratio(F.sum("batted_rates"), F.sum("rated_innings"), None).alias("batting_avg_run_rate"),
    )
    return agg.withColumns(
        {
            "losses": F.col("matches_played") - F.col("wins"),
            "win_percentage": m.percent(F.col("wins"), F.col("matches_played")),
        }
    )


def venue_line(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hosting, scoring and result split. chase_wins counts every match the first side did not win,
    undecided ones included; `undecided` shows how many those are."""
    grain = list(keys) if "city" in keys else [*keys, "city"]
    rate = lambda n: F.col(f"innings{n}_run_rate").cast("decimal(18,2)")
    agg = matches.groupBy(*grain).agg(
        F.count("*").alias("matches_hosted"),
        F.sum("total_runs").alias("runs_total"),
        F.sum("innings1_runs").alias("runs_first"),
        F.sum("innings2_runs").alias("runs_second"),
        F.sum(rate(1)).alias("rate_first"),
        F.sum(rate(2)).alias("rate_second"),
        F.count("total_runs").alias("n_total"),
        F.count("innings1_runs").alias("n_first"),
        F.count("innings2_runs").alias("n_second"),
        F.count(rate(1)).alias("n_rate_first"),
        F.count(rate(2)).alias("n_rate_second"),
        m.count_where(F.col("result_type") == "runs").alias("bat_first_wins"),
        m.count_where(F.col("winner").isNull()).alias("undecided"),
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
    )
    if "city" not in keys:
        agg = one_text(agg, keys, "city")
    hosted = F.col("matches_hosted")
    chases = hosted - F.col("bat_first_wins")
    return agg.withColumns(
        {
            "chase_wins": chases,
            "bat_first_win_pct": m.percent(F.col("bat_first_wins"), hosted),
            "chase_win_pct": m.percent(chases, hosted),
            "avg_run_rate": m.ratio(F.col("rate_first"), F.col("n_rate_first"), None),
            "avg_first_innings_rr": m.ratio(F.col("rate_first"), F.col("n_rate_first")),
            "avg_second_innings_rr": m.ratio(F.col("rate_second"), F.col("n_rate_second")),
            **{
                name: m.ratio(F.col(f"runs_{part}"), F.col(f"n_{part}"), None)
                for name, part in (
                    ("avg_total_runs", "total"),
                    ("avg_first_innings", "first"),
                    ("avg_second_innings", "second"),
                )
            },
        }
    )


def toss_line(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    agg = matches.groupBy(*keys).agg(
        F.count("*").alias("total_matches"),
        m.count_where(F.col("toss_winner") == F.col("winner")).alias("toss_winner_won"),
    )
    return agg.withColumn("toss_advantage_pct", m.percent(F.col("toss_winner_won"), F.col("total_matches")))
