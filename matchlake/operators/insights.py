"""Dashboard rollups: the tables behind each chart and panel."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators import lines
from matchlake.operators.ranking import latest_per_key, top_k
from matchlake.operators.serving import recent_matches

RECENT_COLUMNS = ("date", "team1", "team2", "winner", "margin", "venue")


def match_kpis(matches: DataFrame) -> DataFrame:
    """One row: matches, average total, seasons, and the side with most wins (first by name on a tie)."""
    small = matches.groupBy("season", "winner").agg(
        F.count("*").alias("n"), F.sum("total_runs").alias("runs"), F.count("total_runs").alias("scored")
    )
    ranked = small.withColumn("wins", F.sum("n").over(Window.partitionBy("winner")))
    order = F.when(F.col("winner").isNotNull(), F.struct(-F.col("wins"), "winner"))
    return ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_matches"),
        m.ratio(F.sum("runs"), F.sum("scored"), 0).alias("avg_runs_per_match"),
        F.countDistinct("season").alias("seasons"),
        F.min_by("winner", order).alias("most_wins"),
    )


def player_kpis(balls: DataFrame) -> DataFrame:
    return balls.agg(
        F.countDistinct("batsman").alias("unique_players"),
        F.sum("runs_scored").alias("total_runs"),
        m.count_where(m.is_six()).alias("total_sixes"),
        m.count_where(m.is_four()).alias("total_fours"),
    )


def team_wins(matches: DataFrame, k: int = 10) -> DataFrame:
    wins = matches.where(F.col("winner").isNotNull()).groupBy(F.col("winner").alias("team"))
    return top_k(wins.agg(F.count("*").alias("wins")), [F.col("wins").desc(), F.col("team")], k)


def season_runs(matches: DataFrame) -> DataFrame:
    agg = matches.groupBy("season").agg(F.sum("total_runs").alias("total_runs"), F.count("*").alias("matches"))
    return agg.withColumn("avg_runs", m.ratio(F.col("total_runs"), F.col("matches"), None))


def busiest_venues(matches: DataFrame, k: int = 10) -> DataFrame:
    venues = lines.venue_line(matches, ["venue"]).select(
        "venue", F.col("matches_hosted").alias("matches"), F.col("avg_first_innings").alias("avg_i1")
    )
    return top_k(venues, [F.col("matches").desc(), F.col("venue")], k)


def toss_win_rate(matches: DataFrame, dp: int | None = None) -> DataFrame:
    toss = lines.toss_line(matches, ["toss_decision"])
    return toss.select("toss_decision", m.percent(F.col("toss_winner_won"), F.col("total_matches"), dp).alias("win_rate"))


def top_scorers(balls: DataFrame, k: int = 15) -> DataFrame:
    runs = balls.groupBy(F.col("batsman").alias("player")).agg(F.sum("runs_scored").alias("runs"))
    return top_k(runs, [F.col("runs").desc(), F.col("player")], k)


def phase_rates(balls: DataFrame) -> DataFrame:
    return lines.phase_line(balls, ["phase"]).select(
        "phase",
        "total_runs",
        "total_balls",
        "wickets",
        m.ratio(F.col("total_runs"), F.col("total_balls"), None, m.BALLS_PER_OVER).alias("run_rate"),
    )


def season_match_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("season").agg(F.count("*").alias("matches"))


def recent_results(matches: DataFrame, columns: Sequence[str] = RECENT_COLUMNS) -> DataFrame:
    return recent_matches(matches.select("match_id", *columns), 10)


def batting_leaderboard(balls: DataFrame, k: int = 20) -> DataFrame:
    board = lines.batting_line(balls, ["batsman"]).select(
        "batsman",
        "runs",
        F.col("balls_faced").alias("balls"),
        "fours",
        "sixes",
        "matches",
        "strike_rate",
        F.col("runs_per_match").alias("avg"),
    )
    return top_k(board, [F.col("runs").desc(), F.col("batsman")], k)


def bowling_leaderboard(balls: DataFrame, k: int = 20) -> DataFrame:
    board = lines.bowling_line(balls, ["bowler"]).select(
        "bowler",
        F.col("balls_bowled").alias("balls"),
        "runs_conceded",
        "wickets",
        "matches",
        F.col("economy_rate").alias("economy"),
        F.col("overs_bowled").alias("overs"),
    )
    return top_k(board, [F.col("wickets").desc(), F.col("bowler")], k)


def all_rounders(balls: DataFrame, k: int = 20, runs_above: int = 50, wickets_above: int = 2) -> DataFrame:
    """Players who both batted and bowled, above both thresholds."""
    both = lines.player_line(balls, ["player"]).where(
        (F.col("balls_faced") > 0)
        & (F.col("balls_bowled") > 0)
        & (F.col("runs") > runs_above)
        & (F.col("wickets") > wickets_above)
    )
    return top_k(both.select("player", "runs", "wickets"), [F.col("runs").desc(), F.col("player")], k)


def player_totals(balls: DataFrame, player: str) -> DataFrame:
    """Totals in both roles from one pass over the player's deliveries."""
    bats, bowls = F.col("batsman") == player, F.col("bowler") == player
    agg = balls.where(bats | bowls).agg(
        F.coalesce(F.sum(F.when(bats, F.col("runs_scored"))), F.lit(0)).alias("batting_runs"),
        m.count_where(bats).alias("balls_faced"),
        m.count_where(bowls & m.is_out()).alias("bowling_wickets"),
        F.countDistinct(F.when(bats, F.col("match_id"))).alias("matches"),
    )
    rate = m.strike_rate(F.col("batting_runs"), F.greatest(F.col("balls_faced"), F.lit(1)))
    return agg.select(F.lit(player).alias("player"), "*", rate.alias("strike_rate"))


def player_runs_by_season(balls: DataFrame, player: str) -> DataFrame:
    return balls.where(F.col("batsman") == player).groupBy("season").agg(F.sum("runs_scored").alias("runs_scored"))


def team_seasons(matches: DataFrame, team: str, seasons: Sequence[int] = ()) -> DataFrame:
    """Played, won and win % per season for one team; an empty season list means all."""
    own = matches.where((F.col("team1") == team) | (F.col("team2") == team))
    if seasons:
        own = own.where(F.col("season").isin(*seasons))
    agg = own.groupBy("season").agg(
        F.count("*").alias("total"), m.count_where(F.col("winner") == team).alias("wins")
    )
    return agg.withColumns(
        {
            "losses": F.col("total") - F.col("wins"),
            "win_pct": m.percent(F.col("wins"), F.col("total"), None),
        }
    )


def toss_conversion(matches: DataFrame, team: str) -> DataFrame:
    won = matches.where(F.col("toss_winner") == team).agg(
        F.count("*").alias("tosses_won"), m.count_where(F.col("winner") == team).alias("won_after_toss")
    )
    return won.withColumn("lost_after_toss", F.col("tosses_won") - F.col("won_after_toss"))


def meetings(matches: DataFrame, team: str, other: str) -> DataFrame:
    a = (F.col("team1") == team) & (F.col("team2") == other)
    b = (F.col("team1") == other) & (F.col("team2") == team)
    return matches.where(a | b)


def meeting_record(matches: DataFrame, team: str, other: str) -> DataFrame:
    return meetings(matches, team, other).agg(
        F.count("*").alias("total"),
        m.count_where(F.col("winner") == team).alias("team_wins"),
        m.count_where(F.col("winner") == other).alias("other_wins"),
    )


def recent_for_team(matches: DataFrame, team: str) -> DataFrame:
    return recent_results(matches.where((F.col("team1") == team) | (F.col("team2") == team)))


def venue_table(matches: DataFrame) -> DataFrame:
    venues = lines.venue_line(matches, ["venue", "city"])
    total = F.col("avg_first_innings") + F.col("avg_second_innings")
    return venues.select(
        "venue",
        "city",
        F.col("matches_hosted").alias("matches"),
        F.round("avg_first_innings", 1).alias("avg_i1"),
        F.round("avg_second_innings", 1).alias("avg_i2"),
        F.round(total, 1).alias("avg_total"),
    )


def venue_detail(matches: DataFrame, venue: str) -> DataFrame:
    return lines.venue_line(matches.where(F.col("venue") == venue), ["venue"]).select(
        "venue",
        "city",
        "matches_hosted",
        F.round("avg_first_innings", 0).alias("avg_first_innings"),
        F.round("avg_second_innings", 0).alias("avg_second_innings"),
        "bat_first_wins",
        "chase_wins",
        m.percent(F.col("bat_first_wins"), F.col("matches_hosted"), 0).alias("bat_first_win_pct"),
    )


def venue_toss(matches: DataFrame, venue: str) -> DataFrame:
    return toss_win_rate(matches.where(F.col("venue") == venue), 1)


def recent_at_venue(matches: DataFrame, venue: str) -> DataFrame:
    columns = ("date", "team1", "team2", "winner", "margin", "player_of_match")
    return recent_results(matches.where(F.col("venue") == venue), columns)


def score_distribution(matches: DataFrame, venue: str | None = None, width: int = 10) -> DataFrame:
    """Histogram of both innings' scores in bins of `width` runs, from one scan."""
    found = matches if venue is None else matches.where(F.col("venue") == venue)
    score = lambda n: F.struct(F.lit(n).alias("innings"), F.col(f"innings{n}_runs").alias("runs"))
    scores = found.select(F.inline(F.array(score(1), score(2)))).where(F.col("runs").isNotNull())
    start = (F.floor(F.col("runs") / F.lit(width)) * width).cast("int")
    return scores.groupBy("innings", start.alias("bin_start")).agg(F.count("*").alias("matches"))


def dream_team(balls: DataFrame, batsmen: int = 6, bowlers: int = 5) -> DataFrame:
    """Best batsmen and bowlers by points per match, both roles from one pass."""
    agg = (
        lines.roles(balls)
        .groupBy("role", "player")
        .agg(
            F.sum("runs_scored").alias("runs"),
            F.count("*").alias("balls"),
            m.count_where(m.is_four()).alias("fours"),
            m.count_where(m.is_six()).alias("sixes"),
            m.count_where(m.is_out()).alias("wickets"),
            F.countDistinct("match_id").alias("matches"),
        )
    )
    runs, played = F.col("runs"), F.col("matches")
    bats = F.col("role") == lines.BAT
    points = F.when(bats, runs + F.col("fours") + F.col("sixes") * 2).otherwise(F.col("wickets") * 25)
    scored = agg.select(
        "role",
        "player",
        F.when(bats, runs).otherwise(F.col("wickets")).alias("contribution"),
        F.when(bats, m.strike_rate(runs, F.col("balls"))).otherwise(m.economy(runs, F.col("balls"))).alias("rate"),
        m.ratio(points, played, None).alias("raw"),
    )
    place = F.row_number().over(Window.partitionBy("role").orderBy(F.col("raw").desc(), "player"))
    size = F.when(bats, batsmen).otherwise(bowlers)
    # The constant bound lets every task keep only its best few before the shuffle.
    best = scored.withColumn("_place", place).where(F.col("_place") <= max(batsmen, bowlers))
    return best.where(F.col("_place") <= size).select(
        F.when(bats, "batsman").otherwise("bowler").alias("role"),
        "player",
        "contribution",
        "rate",
        F.round("raw", 1).alias("impact"),
    )


def impact_players(balls: DataFrame, phase: str | None = None, min_balls: int = 20, k: int = 15) -> DataFrame:
    found = balls if phase is None else balls.where(F.col("phase") == phase)
    board = lines.batting_line(found, ["batsman"]).where(F.col("balls_faced") >= min_balls)
    return top_k(
        board.select(
            "batsman",
            "runs",
            F.col("balls_faced").alias("balls"),
            "boundaries",
            "strike_rate",
            F.col("boundary_percentage").alias("boundary_pct"),
        ),
        [F.col("strike_rate").desc(), F.col("batsman")],
        k,
    )


def recent_deliveries(balls: DataFrame, n: int = 10) -> DataFrame:
    """Last n deliveries of every match with their commentary text."""
    order = [F.col(c).desc() for c in ("innings", "over", "ball", "ball_id")]
    dismissal = F.coalesce("dismissal_type", F.lit("unknown"))
    result = F.when(m.is_out(), F.concat(F.lit("WICKET! ("), dismissal, F.lit(")"))).otherwise(
        F.concat(F.col("runs_scored").cast("string"), F.lit(" runs"))
    )
    needed = balls.select(
        "match_id", "innings", "over", "ball", "ball_id", "batsman", "bowler", result.alias("result")
    )
    return latest_per_key(needed, ["match_id"], order, n)


def distinct_names(matches: DataFrame, balls: DataFrame) -> DataFrame:
    """Selector lists: every team (either side), venue and batsman."""
    entry = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("name"))
    listed = F.array(entry("team", "team1"), entry("team", "team2"), entry("venue", "venue"))
    batsmen = balls.select(F.lit("batsman").alias("kind"), F.col("batsman").alias("name"))
    return matches.select(F.inline(listed)).unionByName(batsmen).distinct()
