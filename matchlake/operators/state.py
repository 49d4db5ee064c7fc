"""Running match state per delivery, and match results summarised from deliveries."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.functions import scoring

# Deliveries of an innings are ordered by these; ball_id makes the order unique.
ORDER = ("over", "ball", "ball_id")


def ball_runs() -> Column:
    return F.col("runs_scored") + F.coalesce(F.col("extras"), F.lit(0))


def running_state(balls: DataFrame, split: int = 1, extras_inside: bool = False) -> DataFrame:
    """Adds running totals per innings: total_runs, total_wickets, legal_balls and the chase target.

    A running window over a whole innings would put a match, however large, into one task. Totals
    are therefore taken in two levels: each over is summed first (combined before its shuffle), the
    few over totals of a match give every over its opening score, and only the deliveries of one
    over are walked in order. split=2 cuts at each ball of an over instead, for feeds that repeat
    single overs without bound.
    """
    if extras_inside:
        balls = with_separate_extras(balls)
    if split not in (1, 2):
        raise ValueError("an innings is split by over (1) or by over and ball (2)")
    cut, rest = ORDER[:split], ORDER[split:]
    cell = ["match_id", "innings", *cut]
    counted = balls.withColumns(
        {
            "_r": ball_runs().cast("bigint"),
            "_w": m.is_out().cast("bigint"),
            "_l": m.is_legal().cast("bigint"),
        }
    )
    totals = counted.groupBy(*cell).agg(*[F.sum(c).alias(c) for c in ("_r", "_w", "_l")])
    before = Window.partitionBy("match_id", "innings").orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(
        *cell,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_r", "_w", "_l")],
        F.coalesce(
            F.sum(F.when(F.col("innings") == 1, F.col("_r"))).over(Window.partitionBy("match_id")),
            F.lit(0),
        ).alias("_first_innings"),
    )
    upto = Window.partitionBy(*cell).orderBy(*rest).rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    running = lambda c: F.sum(c).over(upto) + zero(f"{c}0")
    # A left join keeps deliveries whose over is unknown; they sort first, so they open from zero.
    return counted.join(opening, cell, "left").select(
        *balls.columns,
        running("_r").alias("total_runs"),
        running("_w").alias("total_wickets"),
        running("_l").alias("legal_balls"),
        F.when(F.col("innings") == 2, zero("_first_innings") + 1).alias("target"),
    )


def with_run_rate(state: DataFrame) -> DataFrame:
    return state.withColumn(
        "run_rate",
        m.rate_per_over(F.col("total_runs"), F.col("over") * m.BALLS_PER_OVER + F.col("ball")),
    )


def with_chase(state: DataFrame) -> DataFrame:
    """runs_needed, balls_remaining and required_rate; NULL in the first innings."""
    chasing = F.col("target").isNotNull()
    used = F.col("over") * m.BALLS_PER_OVER + F.col("ball")
    return (
        state.withColumn(
            "runs_needed",
            F.when(chasing, F.greatest(F.col("target") - F.col("total_runs"), F.lit(0))),
        )
        .withColumn("balls_remaining", F.when(chasing, F.greatest(F.lit(m.INNINGS_BALLS) - used, F.lit(0))))
        .withColumn("required_rate", m.rate_per_over(F.col("runs_needed"), F.col("balls_remaining")))
        .withColumn("required_rate", F.when(chasing, F.col("required_rate")))
    )


def with_match_state(state: DataFrame) -> DataFrame:
    """Label after the delivery: in_progress, innings_break or completed."""
    bowled = F.col("over") * m.BALLS_PER_OVER + F.col("ball") + m.is_legal().cast("int")
    closed = (F.col("total_wickets") >= 10) | (bowled >= m.INNINGS_BALLS)
    reached = m.is_true(F.col("total_runs") >= F.col("target"))
    return state.withColumn(
        "match_state",
        F.when((F.col("innings") == 1) & closed, "innings_break")
        .when((F.col("innings") != 1) & (reached | closed), "completed")
        .otherwise("in_progress"),
    )


def with_separate_extras(balls: DataFrame) -> DataFrame:
    """A feed whose runs_scored holds the extras as well, in the convention of all operators here: runs_scored off
    the bat, extras apart. Without an `extras` column the runs of a wide and one run of a no-ball are extras."""
    given = F.col("extras") if "extras" in balls.columns else F.lit(None)
    penalty = F.when(F.col("extras_type") == "wide", F.col("runs_scored"))
    penalty = penalty.when(F.col("extras_type") == "noball", F.least(F.lit(1), F.col("runs_scored"))).otherwise(0)
    extra = F.coalesce(given, penalty)
    split = balls.withColumn("_extra", extra.cast("int"))
    bat = (F.col("runs_scored") - F.col("_extra")).cast("int")
    return split.withColumn("runs_scored", bat).withColumn("extras", F.col("_extra")).drop("_extra")


def with_extras_split(balls: DataFrame, extras_inside: bool = False) -> DataFrame:
    """Legal flag and runs split into bat, wide and no-ball shares. extras_inside: runs_scored holds the extras."""
    if extras_inside:
        balls = with_separate_extras(balls)
    extra = F.coalesce(F.col("extras"), F.lit(0))
    of = lambda kind: F.when(F.col("extras_type") == kind, extra).otherwise(0)
    return balls.withColumns(
        {
            "is_legal": m.is_legal(),
            "bat_runs": F.col("runs_scored"),
            "wide_runs": of("wide"),
            "noball_runs": of("noball"),
        }
    )


def with_phase_flags(balls: DataFrame) -> DataFrame:
    return balls.withColumns(
        {
            "phase": m.phase(),
            "is_powerplay": F.col("over") < m.POWERPLAY_OVERS,
            "is_death_overs": F.col("over") >= m.DEATH_FROM_OVER,
        }
    )


def win_probability_per_ball(balls: DataFrame) -> DataFrame:
    """Chase win probability after every second-innings delivery inside the scoring domain."""
    chase = running_state(balls).where(F.col("target").isNotNull())
    shaped = chase.withColumns(
        {
            "score": F.col("total_runs"),
            "wickets": F.col("total_wickets"),
            "overs": F.col("over") + F.col("ball") / F.lit(m.BALLS_PER_OVER),
        }
    )
    return scoring.with_chase_probability(shaped.where(scoring.in_domain()))


def match_results(balls: DataFrame) -> DataFrame:
    """Per match, both innings: runs, wickets and overs as over.ball of the last delivery reached."""
    out = []
    for n in (1, 2):
        inn = F.col("innings") == n
        reached = F.max(F.when(inn, F.col("over") * 10 + F.col("ball") + 1))
        out += [
            F.sum(F.when(inn, ball_runs()).otherwise(0)).alias(f"runs_{n}"),
            m.count_where(inn & m.is_out()).alias(f"wickets_{n}"),
            (reached / F.lit(10)).alias(f"overs_{n}"),
        ]
    return balls.groupBy("match_id").agg(*out)


def summarise_match(balls: DataFrame, tie_rule: str = "defending") -> DataFrame:
    """One match row from its deliveries.

    tie_rule "defending" gives a level match to the side that batted first by "0 runs";
    "undecided" leaves winner NULL and margin "tie".
    """
    if tie_rule not in ("defending", "undecided"):
        raise ValueError(f"unknown tie rule {tie_rule!r}")
    clean = ~m.is_true(F.col("extras_type") != "none")
    # Hashed down to a row or two per innings first, because picking the team names sorts its input.
    per_innings = balls.groupBy("match_id", "innings", "batting_team", "bowling_team").agg(
        F.sum(ball_runs()).alias("runs"),
        m.count_where(m.is_out()).alias("wickets"),
        m.count_where(m.is_legal()).alias("legal"),
        m.count_where(m.is_four() & clean).alias("fours"),
        m.count_where(m.is_six() & clean).alias("sixes"),
    )
    first, second = F.col("innings") == 1, F.col("innings") == 2
    total = lambda inn, c: F.sum(F.when(inn, F.col(c)).otherwise(0)).cast("bigint")
    agg = per_innings.groupBy("match_id").agg(
        F.min(F.when(first, F.col("batting_team"))).alias("innings1_team"),
        total(first, "runs").alias("innings1_runs"),
        total(first, "wickets").alias("innings1_wickets"),
        F.min(F.when(second, F.col("batting_team"))).alias("innings2_team"),
        total(second, "runs").alias("innings2_runs"),
        total(second, "wickets").alias("innings2_wickets"),
        F.sum("legal").alias("total_balls"),
        F.sum("fours").alias("total_fours"),
        F.sum("sixes").alias("total_sixes"),
        F.min(F.when(first, F.col("bowling_team"))).alias("_chasers"),
        F.min(F.when(second, F.col("bowling_team"))).alias("_defenders"),
    )
    lead = F.col("innings1_runs") - F.col("innings2_runs")
    chased = F.concat((F.lit(10) - F.col("innings2_wickets")).cast("string"), F.lit(" wickets"))
    defended = F.concat(lead.cast("string"), F.lit(" runs"))
    level = (lead == 0) if tie_rule == "undecided" else F.lit(False)
    return agg.select(
        "match_id",
        *[c for c in agg.columns if c.startswith("innings")],
        F.when(level, None)
        .when(lead < 0, F.coalesce("innings2_team", "_chasers"))
        .otherwise(F.coalesce("innings1_team", "_defenders"))
        .alias("winner"),
        F.when(level, "tie").when(lead < 0, chased).otherwise(defended).alias("margin"),
        "total_balls",
        "total_fours",
        "total_sixes",
    )


def match_totals_from_feed(events: DataFrame) -> DataFrame:
    """Final score per innings from a feed whose events already carry running totals."""
    last = F.struct("over", "ball", "event_id")
    return events.groupBy("match_id", "innings").agg(
        F.max_by("total_runs", last).alias("runs"),
        F.max_by("total_wickets", last).alias("wickets"),
    )
