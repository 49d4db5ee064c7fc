"""Win probability, projection, fantasy points and pressure as column expressions.

All weights, tiers and bounds are fixed values of the scoring rules.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m

PAR_TOTAL = 165


def in_domain(target="target", score="score", wickets="wickets", overs="overs") -> Column:
    """target > 0, score >= 0, 0 <= wickets <= 10, 0 <= overs <= 20; NULLs are out of domain."""
    return m.is_true(
        (F.col(target) > 0)
        & (F.col(score) >= 0)
        & F.col(wickets).between(0, 10)
        & F.col(overs).between(0, m.INNINGS_OVERS)
    )


def quarantine(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits match states into scoreable and out-of-domain rows."""
    good = F.coalesce(in_domain(), F.lit(False))
    return states.where(good), states.where(~good)


def with_chase_probability(states: DataFrame) -> DataFrame:
    """Adds chase win probability to rows with target, score, wickets and overs.

    Built in steps, so that each intermediate value is computed once per row.
    """
    score, wickets, overs = (F.col(c) for c in ("score", "wickets", "overs"))
    need, balls = F.col("runs_needed"), F.col("balls_remaining")
    state = states.withColumns(
        {
            "runs_needed": F.col("target") - score,
            "balls_remaining": F.greatest(F.lit(1), ((F.lit(20) - overs) * 6).cast("int")),
            "wickets_in_hand": F.lit(10) - wickets,
        }
    )
    rates = state.withColumns(
        {
            "_required": need / balls * 6,
            "_current": score / F.greatest(F.lit(1.0), overs * 6) * 6,
            "_wicket_factor": F.col("wickets_in_hand") / F.lit(10.0),
        }
    )
    rate_factor = F.col("_current") / F.greatest(F.lit(0.1), F.col("_required"))
    wicket_factor = F.col("_wicket_factor")
    resources = balls / F.lit(120) * wicket_factor
    logistic = F.lit(1) / (F.lit(1) + F.exp((rate_factor - 1) * F.lit(-2)))
    blend = logistic * F.lit(0.6) + resources * F.lit(0.3) + wicket_factor * F.lit(0.1)
    dampened = F.when(wickets >= 8, F.lit(0.4)).when(wickets >= 6, F.lit(0.7)).otherwise(F.lit(1.0)) * blend
    decided = rates.withColumn("_decided", F.when(need <= 0, F.lit(1.0)).otherwise(dampened))
    return (
        decided.withColumn("_p", _clamp(F.col("_decided"), 0.01, 0.99))
        .withColumns(
            {
                "batting_win_probability": F.round("_p", 4),
                "bowling_win_probability": F.round(F.lit(1) - F.col("_p"), 4),
                "required_rate": F.round("_required", 2),
                "current_rate": F.round("_current", 2),
            }
        )
        .drop("_required", "_current", "_wicket_factor", "_decided", "_p")
    )


def _clamp(value: Column, low: float, high: float) -> Column:
    """value within [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def projected_total(score: Column, wickets: Column, overs: Column) -> Column:
    """First-innings projection; par when nothing has been bowled."""
    acceleration = F.when(overs < 6, F.lit(1.3)).when(overs < 15, F.lit(1.15)).otherwise(F.lit(1.05))
    penalty = F.greatest(F.lit(0.5), F.lit(1) - wickets * F.lit(0.08))
    rest = F.try_divide(score.cast("double"), overs.cast("double")) * (F.lit(20) - overs) * acceleration * penalty
    return F.when(overs <= 0, F.lit(float(PAR_TOTAL))).otherwise(score + rest)


def with_first_innings_probability(states: DataFrame) -> DataFrame:
    projected = states.withColumn("_total", projected_total(F.col("score"), F.col("wickets"), F.col("overs")))
    raw = F.lit(0.5) + (F.col("_total") - PAR_TOTAL) * F.lit(0.008) - F.col("wickets") * F.lit(0.03)
    return (
        projected.withColumn("_raw", raw)
        .withColumn("_p", _clamp(F.col("_raw"), 0.05, 0.95))
        .withColumns(
            {
                "batting_win_probability": F.round("_p", 4),
                "bowling_win_probability": F.round(F.lit(1) - F.col("_p"), 4),
                # Halves go to the even total, so a projection of 170.5 reads 170.
                "projected_total": F.bround("_total", 0).cast("bigint"),
            }
        )
        .drop("_total", "_raw", "_p")
    )


def with_win_probability(states: DataFrame) -> DataFrame:
    """Win probability for mixed states, told apart by the boolean is_chasing.

    Rates, needs and balls are filled when chasing, the projected total otherwise.
    """
    sides = ("batting_win_probability", "bowling_win_probability")
    chase = with_chase_probability(states).withColumnsRenamed({c: f"_chase_{c}" for c in sides})
    both = with_first_innings_probability(chase)
    chasing = m.is_true(F.col("is_chasing"))
    only_chasing = ("required_rate", "current_rate", "runs_needed", "balls_remaining", "wickets_in_hand")
    return both.withColumns(
        {c: F.when(chasing, F.col(f"_chase_{c}")).otherwise(F.col(c)) for c in sides}
        | {c: F.when(chasing, F.col(c)) for c in only_chasing}
        | {"projected_total": F.when(~chasing, F.col("projected_total"))}
    ).drop(*[f"_chase_{c}" for c in sides])


def _if(condition: Column, points: int) -> Column:
    return F.when(m.is_true(condition), points).otherwise(0)


def simple_fantasy_points() -> Column:
    """Warehouse points: runs, boundaries, wickets, 50/100 and three-wicket bonuses only."""
    runs, wickets = F.col("runs"), F.col("wickets")
    return (
        runs
        + F.col("fours")
        + F.col("sixes") * 2
        + wickets * 25
        + _if(runs >= 50, 25)
        + _if(runs >= 100, 50)
        + _if(wickets >= 3, 25)
    ).cast("double")


def _tiers(*rules: tuple[Column, int]) -> Column:
    expr = None
    for condition, points in rules:
        expr = F.when(condition, points) if expr is None else expr.when(condition, points)
    return expr.otherwise(0)


def fantasy_points() -> dict[str, Column]:
    """Full scoring over runs, balls_faced, fours, sixes, wickets, overs_bowled, runs_conceded,
    catches and run_outs: batting, bowling, fielding and total points."""
    runs, balls, wickets = F.col("runs"), F.col("balls_faced"), F.col("wickets")
    sr = F.try_divide((runs * 100).cast("double"), balls.cast("double"))
    eco = F.try_divide(F.col("runs_conceded").cast("double"), F.col("overs_bowled").cast("double"))
    sr_points = _tiers(
        (balls <= 0, 0),
        (sr >= 170, 6),
        (sr >= 150, 4),
        (sr >= 130, 2),
        ((sr < 60) & (balls >= 10), -6),
        ((sr < 70) & (balls >= 10), -4),
    )
    eco_points = _tiers(
        (F.col("overs_bowled") < 2, 0),
        (eco <= 5, 6),
        (eco <= 6, 4),
        (eco <= 7, 2),
        (eco >= 12, -6),
        (eco >= 11, -4),
    )
    batting = (
        runs
        + F.col("fours")
        + F.col("sixes") * 2
        + _if(runs >= 50, 25)
        + _if(runs >= 100, 50)
        + _if((runs == 0) & (balls > 0), -2)
        + sr_points
    )
    bowling = wickets * 25 + _if(wickets >= 3, 25) + _if(wickets >= 5, 50) + eco_points
    fielding = F.col("catches") * 8 + F.col("run_outs") * 12
    points = {
        "batting_points": batting,
        "bowling_points": bowling,
        "fielding_points": fielding,
        "total_fantasy_points": batting + bowling + fielding,
    }
    return {name: F.round(value.cast("double"), 1) for name, value in points.items()}


def with_pressure(states: DataFrame) -> DataFrame:
    """Pressure index and label from runs_needed, balls_remaining and wickets_in_hand.

    The label is read off the unrounded index.
    """
    need, balls, in_hand = F.col("runs_needed"), F.col("balls_remaining"), F.col("wickets_in_hand")
    required = F.when(balls > 0, F.try_divide(need.cast("double"), balls.cast("double")) * 6).otherwise(F.lit(999.0))
    pressure = states.withColumns({"_required": required, "_wicket": (F.lit(10) - in_hand) / F.lit(10.0)})
    rated = pressure.withColumn("_rate", F.least(F.col("_required") / F.lit(12.0), F.lit(1.0)))
    ball = F.lit(1) - balls / F.lit(120.0)
    index = (F.col("_rate") * F.lit(0.4) + F.col("_wicket") * F.lit(0.35) + ball * F.lit(0.25)) * 100
    at = F.col("_index")
    return (
        rated.withColumn("_index", index)
        .withColumns(
            {
                "pressure_index": F.round(at, 1),
                "required_rate": F.round("_required", 2),
                "wicket_pressure": F.round(F.col("_wicket") * 100, 1),
                "rate_pressure": F.round(F.col("_rate") * 100, 1),
                "assessment": F.when(at > 80, "extreme")
                .when(at > 60, "high")
                .when(at > 40, "moderate")
                .when(at.isNotNull(), "low"),
            }
        )
        .drop("_required", "_wicket", "_rate", "_index")
    )


def live_indicators(states: DataFrame) -> DataFrame:
    """Score line, runs still needed when chasing, otherwise the total projected at this rate."""
    chasing = F.coalesce(F.col("target"), F.lit(0)) != 0
    return states.withColumns(
        {
            "score_line": F.concat_ws("/", "total_runs", "total_wickets"),
            "runs_needed": F.when(chasing, F.greatest(F.lit(0), F.col("target") - F.col("total_runs"))),
            "projected": F.when(~chasing, (F.col("run_rate") * 20).cast("int")),
        }
    )
