"""Column expressions shared by every layer: flags, phases and null-safe ratios.

Where the published definitions of a metric disagree, the difference is an argument here rather
than a silent choice in an operator.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

BALLS_PER_OVER = 6
INNINGS_OVERS = 20
INNINGS_BALLS = INNINGS_OVERS * BALLS_PER_OVER
POWERPLAY_OVERS = 6
DEATH_FROM_OVER = 16
ILLEGAL_DELIVERIES = ("wide", "noball")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column, den: Column | int, dp: int | None = 2, scale: int = 1) -> Column:
    """scale*num/den as double, NULL on a zero denominator, rounded once after one division."""
    den = F.lit(den) if isinstance(den, int) else den
    value = F.try_divide((num * F.lit(scale)).cast("double"), den.cast("double"))
    return value if dp is None else F.round(value, dp)


def strike_rate(runs: Column, balls: Column) -> Column:
    return ratio(runs, balls, 2, 100)


def percent(part: Column, whole: Column, dp: int | None = 2) -> Column:
    return ratio(part, whole, dp, 100)


def overs_from_balls(balls: Column) -> Column:
    """Overs as balls/6 to one decimal."""
    return ratio(balls, BALLS_PER_OVER, 1)


def economy(runs: Column, balls: Column) -> Column:
    """Runs per over, over = exactly six balls."""
    return ratio(runs, balls, 2, BALLS_PER_OVER)


def economy_of_rounded_overs(runs: Column, balls: Column) -> Column:
    """Runs per over where overs were first rounded to one decimal (warehouse definition)."""
    tenths = F.round(F.try_divide((balls * 10).cast("double"), F.lit(float(BALLS_PER_OVER))))
    return ratio(runs, tenths, 2, 10)


def exact_avg(value: Column, dp: int | None = None) -> Column:
    """Mean of a two-decimal rate through decimal sums, so it does not depend on row order."""
    exact = value.cast("decimal(18,2)")
    mean = F.try_divide(F.sum(exact).cast("double"), F.count(exact).cast("double"))
    return mean if dp is None else F.round(mean, dp)


def int_avg(value: Column, dp: int | None = None) -> Column:
    mean = F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))
    return mean if dp is None else F.round(mean, dp)


def is_true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def count_where(flag: Column) -> Column:
    return F.count_if(is_true(flag))


def same(a: Column, b: Column) -> Column:
    """a = b with NULL read as false."""
    return is_true(a == b)


def is_dot(rule: str = "bat") -> Column:
    """Dot ball: no runs off the bat ("bat"), or neither runs nor extras ("all")."""
    if rule == "bat":
        return is_true(F.col("runs_scored") == 0)
    if rule == "all":
        return is_true((F.col("runs_scored") == 0) & (F.col("extras") == 0))
    raise ValueError(f"unknown dot rule {rule!r}")


def is_four() -> Column:
    return is_true(F.col("runs_scored") == 4)


def is_six() -> Column:
    return is_true(F.col("runs_scored") == 6)


def is_boundary() -> Column:
    return is_true(F.col("runs_scored").isin(4, 6))


def is_out(exclude_run_outs: bool = False) -> Column:
    """Wicket charged to striker and credited to bowler; run-outs count unless excluded."""
    out = is_true(F.col("is_wicket"))
    if exclude_run_outs:
        out = out & ~is_true(F.col("dismissal_type") == "run out")
    return out


def is_legal() -> Column:
    """Wides and no-balls do not advance the over."""
    return ~is_true(F.col("extras_type").isin(*ILLEGAL_DELIVERIES))


def phase(over: Column | str = "over") -> Column:
    over = col(over)
    return (
        F.when(over < POWERPLAY_OVERS, "powerplay")
        .when(over < DEATH_FROM_OVER, "middle")
        .otherwise("death")
    )


def ball_number(over: Column | str = "over", ball: Column | str = "ball") -> Column:
    """1-based position of a delivery in its innings."""
    return col(over) * BALLS_PER_OVER + col(ball) + 1


def batting_first() -> Column:
    """Side that bats first, from the toss."""
    other = F.when(F.col("toss_winner") == F.col("team1"), F.col("team2")).otherwise(F.col("team1"))
    return F.when(F.col("toss_decision") == "bat", F.col("toss_winner")).otherwise(other)


def rate_per_over(runs: Column, balls: Column) -> Column:
    """runs / max(balls/6, 0.1): the live feeds floor the overs at a tenth."""
    return F.when(balls > 0, economy(runs, balls)).otherwise(F.round((runs * 10).cast("double"), 2))
