"""Parametrised serving rollups: listings, rankings and head-to-head."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators import lines
from matchlake.operators.ranking import page_with_total, top_k, total, with_ordinal


def _in_season(df: DataFrame, season: int | None) -> DataFrame:
    return df if season is None else df.where(F.col("season") == season)


PLAYER_STATS = (
    "matches_played total_runs fours sixes batting_average strike_rate total_wickets economy_rate"
).split()


def player_stats(
    players: DataFrame,
    balls: DataFrame,
    season: int | None = None,
    role: str | None = None,
    exclude_run_outs: bool = False,
) -> DataFrame:
    """Every registered player with batting and bowling totals; zeros for those without deliveries."""
    totals = lines.player_line(_in_season(balls, season), ["player"], exclude_run_outs=exclude_run_outs).select(
        F.col("player").alias("player_name"),
        F.col("matches").alias("matches_played"),
        F.col("runs").alias("total_runs"),
        "fours",
        "sixes",
        F.col("runs_per_dismissal").alias("batting_average"),
        "strike_rate",
        F.col("wickets").alias("total_wickets"),
        "economy_rate",
    )
    roster = players.withColumn("role", F.coalesce("role", F.lit("Unknown")))
    if role is not None:
        roster = roster.where(F.lower("role") == role.lower())
    return roster.join(totals, "player_name", "left").select(
        "player_id",
        "player_name",
        F.coalesce("nationality", F.lit("Unknown")).alias("nationality"),
        "role",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in PLAYER_STATS],
    )


def get_players(
    players: DataFrame,
    balls: DataFrame,
    page: int = 1,
    per_page: int = 20,
    sort_by: str = "total_runs",
    role: str | None = None,
    exclude_run_outs: bool = False,
) -> DataFrame:
    """A page of players and the total over all pages."""
    stats = player_stats(players, balls, role=role, exclude_run_outs=exclude_run_outs)
    text = dict(stats.dtypes)[sort_by] == "string"
    bucket = F.left(sort_by, F.lit(3)) if text else F.floor(F.col(sort_by))
    return page_with_total(stats, [F.col(sort_by).desc(), F.col("player_id")], bucket, True, page, per_page)


def count_players(players: DataFrame, balls: DataFrame, role: str | None = None) -> DataFrame:
    """The total of get_players as one row, whatever the page."""
    return total(player_stats(players, balls, role=role))


def _named(column: str, text: str) -> Column:
    return m.is_true(F.lower(column).contains(text.lower()))


def filter_matches(matches: DataFrame, season: int | None = None, team: str | None = None) -> DataFrame:
    found = _in_season(matches, season)
    return found if team is None else found.where(_named("team1", team) | _named("team2", team))


def get_matches(
    matches: DataFrame, page: int = 1, per_page: int = 20, season: int | None = None, team: str | None = None
) -> DataFrame:
    """A page of matches, newest first, and the total over all pages."""
    return page_with_total(filter_matches(matches, season, team), _newest(), F.col("date"), True, page, per_page)


def count_matches(matches: DataFrame, season: int | None = None, team: str | None = None) -> DataFrame:
    """The total of get_matches as one row, whatever the page."""
    return total(filter_matches(matches, season, team))


def _newest() -> list[Column]:
    return [F.col("date").desc(), F.col("match_id")]


def recent_matches(matches: DataFrame, limit: int = 10) -> DataFrame:
    if not 1 <= limit <= 50:
        raise ValueError("limit is 1 to 50")
    return top_k(matches, _newest(), limit)


def _pairings(matches: DataFrame) -> DataFrame:
    """Matches counted per season, pairing and winner: all any team record needs, in few rows."""
    return matches.groupBy("season", "team1", "team2", "winner").agg(F.count("*").alias("n"))


def _records(pairings: DataFrame) -> DataFrame:
    either = F.explode(F.array("team1", "team2")).alias("team_name")
    agg = (
        pairings.select("season", "winner", "n", either)
        .groupBy("team_name")
        .agg(
            F.sum("n").alias("matches_played"),
            F.sum(F.when(F.col("winner") == F.col("team_name"), F.col("n")).otherwise(0)).alias("wins"),
            F.countDistinct("season").alias("seasons_played"),
        )
    )
    played, wins = F.col("matches_played"), F.col("wins")
    return agg.withColumns({"losses": played - wins, "win_percentage": m.percent(wins, played)})


def team_stats(matches: DataFrame, name: str | None = None, season: int | None = None) -> DataFrame:
    records = _records(_pairings(_in_season(matches, season)))
    return records if name is None else records.where(_named("team_name", name))


def team_rankings(matches: DataFrame, season: int | None = None) -> DataFrame:
    order = [F.col("win_percentage").desc(), F.col("team_name")]
    return with_ordinal(team_stats(matches, season=season), order, "rank", F.col("win_percentage"), descending=True)


def head_to_head(matches: DataFrame, team1: str, team2: str, match: str = "contains") -> DataFrame:
    """Both teams' records and their meetings in one row; zeros for an unknown team.

    match "contains" resolves names by substring, "exact" by equality. Of several teams matching a
    substring the first by name is taken.
    """
    if match not in ("contains", "exact"):
        raise ValueError(f"unknown match rule {match!r}")

    def hit(column: str, text: str) -> Column:
        return _named(column, text) if match == "contains" else m.is_true(F.col(column) == text)

    fields = ("matches_played", "wins", "losses", "win_percentage", "seasons_played")
    # Both records and the meetings are read off the same few counts, whose exchange Spark reuses.
    pairings = _pairings(matches)
    stats = _records(pairings)

    def record(text: str) -> DataFrame:
        """One row, whatever the name matches."""
        found = stats.where(hit("team_name", text))
        first = found.agg(F.min_by(F.struct("team_name", *fields), "team_name").alias("t"))
        zeros = [F.coalesce(F.col(f"t.{c}"), F.lit(0)).alias(c) for c in fields]
        return first.select(F.struct(F.coalesce("t.team_name", F.lit(text)).alias("name"), *zeros).alias("t"))

    either = lambda text: hit("team1", text) | hit("team2", text)
    sides = {1: record(team1), 2: record(team2)}
    won = {n: F.sum(F.when(F.col("winner") == F.col(f"_name{n}"), F.col("n"))) for n in sides}
    meetings = (
        pairings.where(either(team1) & either(team2))
        .withColumns({f"_name{n}": side.select("t.name").scalar() for n, side in sides.items()})
        .agg(
            F.sum("n").alias("meetings"),
            won[1].alias("head_to_head_team1_wins"),
            won[2].alias("head_to_head_team2_wins"),
        )
        .na.fill(0)
        .withColumns({f"_t{n}": side.scalar() for n, side in sides.items()})
    )
    return meetings.select(
        *[F.col(f"_t{n}.{c}").alias(f"team{n}_{c}") for n in sides for c in ("name", *fields)],
        "meetings",
        "head_to_head_team1_wins",
        "head_to_head_team2_wins",
    )


def venue_stats(matches: DataFrame) -> DataFrame:
    """One row per venue; a venue listed under several cities takes the first by name."""
    return lines.venue_line(matches, ["venue"]).select(
        F.col("venue").alias("venue_name"),
        "city",
        "matches_hosted",
        F.round("avg_first_innings", 1).alias("avg_first_innings"),
        F.round("avg_second_innings", 1).alias("avg_second_innings"),
        "bat_first_win_pct",
        "chase_win_pct",
    )


def best_batting_venues(matches: DataFrame, limit: int = 5) -> DataFrame:
    return top_k(venue_stats(matches), [F.col("avg_first_innings").desc(), F.col("venue_name")], limit)


def chase_friendly_venues(matches: DataFrame, limit: int = 5) -> DataFrame:
    return top_k(venue_stats(matches), [F.col("chase_win_pct").desc(), F.col("venue_name")], limit)


def season_summary(matches: DataFrame) -> DataFrame:
    agg = matches.groupBy("season").agg(F.count("*").alias("matches"), F.sum("total_runs").alias("total_runs"))
    return agg.withColumn("avg_runs_per_match", m.ratio(F.col("total_runs"), F.col("matches"), 1))


def extended_season_summary(matches: DataFrame, balls: DataFrame) -> DataFrame:
    scores = matches.groupBy("season").agg(
        F.count("*").alias("total_matches"),
        F.sum("total_runs").alias("total_runs"),
        F.max(F.greatest("innings1_runs", "innings2_runs")).alias("highest_team_score"),
        F.min(F.least("innings1_runs", "innings2_runs")).alias("lowest_team_score"),
    )
    hits = balls.groupBy("season").agg(
        m.count_where(m.is_six()).alias("total_sixes"),
        m.count_where(m.is_four()).alias("total_fours"),
    )
    return scores.join(hits, "season", "left").select(
        "season",
        "total_matches",
        "total_runs",
        m.ratio(F.col("total_runs"), F.col("total_matches"), 1).alias("avg_runs_per_match"),
        F.coalesce("total_sixes", F.lit(0)).alias("total_sixes"),
        F.coalesce("total_fours", F.lit(0)).alias("total_fours"),
        "highest_team_score",
        "lowest_team_score",
    )


def top_batsmen(players: DataFrame, balls: DataFrame, limit: int = 10, season: int | None = None) -> DataFrame:
    return top_k(player_stats(players, balls, season), [F.col("total_runs").desc(), F.col("player_id")], limit)


def top_bowlers(
    players: DataFrame,
    balls: DataFrame,
    limit: int = 10,
    role: str | None = "Bowler",
    season: int | None = None,
) -> DataFrame:
    stats = player_stats(players, balls, season, role)
    return top_k(stats, [F.col("total_wickets").desc(), F.col("player_id")], limit)


def strike_rate_leaders(players: DataFrame, balls: DataFrame, limit: int = 10, min_runs: int = 100) -> DataFrame:
    """Qualified players first, then the top k, so no qualifier is lost to an earlier cut."""
    stats = player_stats(players, balls).where(F.col("total_runs") >= min_runs)
    return top_k(stats, [F.col("strike_rate").desc(), F.col("player_id")], limit)
