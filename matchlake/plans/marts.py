"""Registered queries: star schema, incremental and history, serving, quality and live streams."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from matchlake.functions import metrics as m
from matchlake.operators import incremental, quality, serving, sketches, summary, warehouse
from matchlake.plans.base import cnt, query, r
from matchlake.plans.lake import STG_MATCHES_SQL
from matchlake.schemas import LIVE_BALL_EVENT
from matchlake.sources import payloads
from matchlake.sources.bronze import with_metadata
from matchlake.streaming import live

DOT_ALL = cnt("runs_scored = 0 AND extras = 0")

BATTING_STATS_SQL = f"""
  SELECT season, match_id, batsman AS player_name, batting_team AS team, innings, sum(runs_scored) AS runs,
    count(*) AS balls_faced, {cnt("runs_scored = 4")} AS fours, {cnt("runs_scored = 6")} AS sixes,
    {DOT_ALL} AS dot_balls, {cnt("runs_scored IN (4, 6)")} AS boundaries,
    max(CASE WHEN is_wicket THEN 1 ELSE 0 END) AS was_dismissed,
    {r("100 * sum(runs_scored) / count(*)")} AS strike_rate
  FROM balls GROUP BY season, match_id, batsman, batting_team, innings"""


def economy_sql(runs: str, n: str) -> str:
    """Runs over overs first rounded to tenths: (20n + 6) // 12 is ten times the rounded overs."""
    return r(f"10 * {runs} / ((20 * {n} + 6) // 12)")


BOWLING_STATS_SQL = f"""
  SELECT season, match_id, bowler AS player_name, bowling_team AS team, innings,
    sum(runs_scored) AS runs_conceded, count(*) AS balls_bowled, {cnt("is_wicket")} AS wickets,
    {DOT_ALL} AS dot_balls, {r("count(*) / 6", 1)} AS overs_bowled,
    {economy_sql("sum(runs_scored)", "count(*)")} AS economy_rate
  FROM balls GROUP BY season, match_id, bowler, bowling_team, innings"""


@query(
    "p1_bronze_metadata",
    "player_id: bigint; player_name _source _batch_id: string; _ingestion_timestamp: timestamp_ntz; _ingestion_date: date",
    """SELECT player_id, player_name, 'register' AS _source, '20240102_030405' AS _batch_id,
         TIMESTAMP '2024-01-02 03:04:05' AS _ingestion_timestamp, DATE '2024-01-02' AS _ingestion_date FROM players""",
)
def _(t):
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    return with_metadata(t.players, "register", "20240102_030405", at)


@query(
    "w1_batting_stats",
    "season: int; match_id: bigint; player_name team: string; innings: int; "
    "runs balls_faced fours sixes dot_balls boundaries: bigint; was_dismissed: int; strike_rate: double",
    BATTING_STATS_SQL,
)
def _(t):
    return warehouse.batting_stats(t.stg_balls)


@query(
    "w2_bowling_stats",
    "season: int; match_id: bigint; player_name team: string; innings: int; "
    "runs_conceded balls_bowled wickets dot_balls: bigint; overs_bowled economy_rate: double",
    BOWLING_STATS_SQL,
)
def _(t):
    return warehouse.bowling_stats(t.stg_balls)


DIM_PLAYER_COLUMNS = (
    "player_id: bigint; player_name nationality: string; date_of_birth: date; player_role: string; "
    "matches_played total_runs total_balls_faced total_fours total_sixes highest_score: bigint; "
    "batting_average career_strike_rate: double; fifties centuries total_wickets: bigint; career_economy: double; "
    "best_bowling_figures: bigint"
)
DIM_PLAYER_SQL = f"""SELECT player_id, p.player_name, nationality, date_of_birth, role AS player_role,
          coalesce(matches_played, 0) AS matches_played, coalesce(total_runs, 0) AS total_runs,
          coalesce(faced, 0) AS total_balls_faced, coalesce(b.fours, 0) AS total_fours,
          coalesce(b.sixes, 0) AS total_sixes, coalesce(best, 0) AS highest_score,
          coalesce(average, 0) AS batting_average, coalesce(sr, 0) AS career_strike_rate,
          coalesce(fifties, 0) AS fifties, coalesce(centuries, 0) AS centuries,
          coalesce(total_wickets, 0) AS total_wickets, coalesce(economy, 0) AS career_economy,
          coalesce(best_wickets, 0) AS best_bowling_figures
        FROM players p
        LEFT JOIN (
          SELECT player_name, count(DISTINCT match_id) AS matches_played, sum(runs) AS total_runs,
            sum(balls_faced) AS faced, sum(fours) AS fours, sum(sixes) AS sixes, max(runs) AS best,
            {r("sum(runs) / count(*)")} AS average, {r("100 * sum(runs) / sum(balls_faced)")} AS sr,
            {cnt("runs >= 50")} AS fifties, {cnt("runs >= 100")} AS centuries
          FROM ({BATTING_STATS_SQL}) GROUP BY player_name) b ON p.player_name = b.player_name
        LEFT JOIN (
          SELECT player_name, sum(wickets) AS total_wickets, max(wickets) AS best_wickets,
            {r("CAST(sum(CAST(economy_rate AS DECIMAL(18,2))) AS DOUBLE) / count(economy_rate)")} AS economy
          FROM ({BOWLING_STATS_SQL}) GROUP BY player_name) w ON p.player_name = w.player_name"""


@query("w3_dim_player", DIM_PLAYER_COLUMNS, DIM_PLAYER_SQL)
def _(t):
    return warehouse.dim_player(t.stg_players, t.stg_balls)


def _older(rows, day: str, **wrong):
    """An earlier state of a table: rows up to a season, the last of it with values since corrected."""
    known = rows.where(F.col("season") <= day)
    last = F.col("season") == F.lit(day)
    return known.withColumns({c: F.when(last, v).otherwise(F.col(c)).cast(known.schema[c].dataType) for c, v in wrong.items()})


@query("w3_dim_player_by_delta", DIM_PLAYER_COLUMNS, DIM_PLAYER_SQL)
def _(t):
    # Careers up to 1996, with runs of that season twice what they are, brought up to date by what changed since.
    balls = t.stg_balls
    old = summary.player_lines(_older(balls, 1996, runs_scored=F.col("runs_scored") * 2))
    new = summary.player_lines(balls)
    careers = summary.CAREERS.partial(old)
    change = summary.CAREERS.change(old.where("season >= 1996"), new.where("season >= 1996"))
    merged = summary.CAREERS.merged(careers, change, new)
    return summary.dim_player(t.stg_players, summary.CAREERS.replaced(careers, merged))


TEAM_RECORD_SQL = f"""
  SELECT team AS team_name, count(*) AS total_matches, {cnt("winner = team")} AS total_wins,
    count(*) - count(*) FILTER (WHERE winner = team) AS total_losses,
    {r("100 * count(*) FILTER (WHERE winner = team) / count(*)")} AS win_percentage,
    min(season) AS first_season, max(season) AS last_season, count(DISTINCT season) AS seasons_played
  FROM sides GROUP BY team"""


@query(
    "w4_dim_team",
    "team_id: bigint; team_name: string; total_matches total_wins total_losses: bigint; win_percentage: double; "
    "first_season last_season: int; seasons_played: bigint",
    f"SELECT row_number() OVER (ORDER BY team_name) AS team_id, * FROM ({TEAM_RECORD_SQL})",
)
def _(t):
    return warehouse.dim_team(t.stg_matches)


@query(
    "w4_team_record_by_delta",
    "team_name: string; total_matches total_wins total_losses: bigint; win_percentage: double; "
    "first_season last_season: int; seasons_played: bigint",
    TEAM_RECORD_SQL,
)
def _(t):
    # Team seasons up to 1996, when all matches of that season were won by the first team, brought up to date.
    matches = t.stg_matches
    old, new = summary.team_lines(_older(matches, 1996, winner=F.col("team1"))), summary.team_lines(matches)
    seasons = summary.TEAM_SEASONS.partial(old)
    change = summary.TEAM_SEASONS.change(old.where("season >= 1996"), new.where("season >= 1996"))
    merged = summary.TEAM_SEASONS.merged(seasons, change, new)
    return summary.team_record(summary.TEAM_SEASONS.replaced(seasons, merged))


@query(
    "w5_dim_venue",
    "venue_id: bigint; venue_name city country: string; matches_hosted: bigint; "
    "avg_match_total avg_first_innings_score avg_second_innings_score: double; bat_first_wins chase_wins: bigint; "
    "bat_first_win_pct chase_win_pct avg_first_innings_rr avg_second_innings_rr: double; "
    "first_match_season last_match_season: int",
    f"""SELECT row_number() OVER (ORDER BY venue, city) AS venue_id, venue AS venue_name, city, 'India' AS country,
          count(*) AS matches_hosted, {r("sum(total_runs) / count(*)", 1)} AS avg_match_total,
          {r("sum(innings1_runs) / count(*)", 1)} AS avg_first_innings_score,
          {r("sum(innings2_runs) / count(*)", 1)} AS avg_second_innings_score,
          {cnt("batting_first_won")} AS bat_first_wins, {cnt("NOT batting_first_won")} AS chase_wins,
          {r("100 * count(*) FILTER (WHERE batting_first_won) / count(*)")} AS bat_first_win_pct,
          {r("100 - " + r("100 * count(*) FILTER (WHERE batting_first_won) / count(*)"))} AS chase_win_pct,
          {r("CAST(sum(CAST(innings1_run_rate AS DECIMAL(18,2))) AS DOUBLE) / count(innings1_run_rate)")}
            AS avg_first_innings_rr,
          {r("CAST(sum(CAST(innings2_run_rate AS DECIMAL(18,2))) AS DOUBLE) / count(innings2_run_rate)")}
            AS avg_second_innings_rr,
          min(season) AS first_match_season, max(season) AS last_match_season
        FROM ({STG_MATCHES_SQL}) GROUP BY venue, city""",
)
def _(t):
    return warehouse.dim_venue(t.stg_matches)


@query(
    "w6_dim_match",
    "match_id: bigint; season: int; match_date: date; team1 team2 winner result_type: string; total_match_runs: int; "
    "innings1_run_rate: decimal(10,2); scoring_category: string",
    f"""SELECT *, CASE WHEN total_match_runs > 400 THEN 'very_high_scoring' WHEN total_match_runs > 350 THEN 'high_scoring'
            WHEN total_match_runs > 300 THEN 'moderate' WHEN total_match_runs > 250 THEN 'low_scoring'
            ELSE 'very_low_scoring' END AS scoring_category
        FROM ({STG_MATCHES_SQL})""",
)
def _(t):
    return warehouse.dim_match(t.stg_matches)


BALL_FACT_COLUMNS = (
    "ball_id: string; match_id: bigint; season innings over_number ball_number_in_over ball_number: int; "
    "batting_team bowling_team batsman non_striker bowler: string; runs_scored extras: int; extras_type: string; "
    "is_wicket: boolean; dismissal_type: string; is_dot_ball is_boundary is_four is_six: boolean; "
    "match_phase: string; _loaded_at: timestamp_ntz"
)
BALL_FACT_SQL = """
  SELECT *, over AS over_number, ball AS ball_number_in_over, over * 6 + ball + 1 AS ball_number,
    runs_scored = 0 AND extras = 0 AS is_dot_ball, runs_scored IN (4, 6) AS is_boundary,
    runs_scored = 4 AS is_four, runs_scored = 6 AS is_six, phase AS match_phase, loaded_at AS _loaded_at
  FROM balls"""


@query("w7_fact_ball_events", BALL_FACT_COLUMNS, BALL_FACT_SQL)
def _(t):
    return warehouse.fact_ball_events(t.stg_balls)


@query(
    "i1_high_water_rows",
    BALL_FACT_COLUMNS,
    BALL_FACT_SQL + " WHERE loaded_at > (SELECT max(opened) FROM header WHERE season < 1999)",
)
def _(t):
    # What an incremental run adds when everything up to the 1998 season was loaded before.
    loaded = t.stg_matches.where(F.col("season") < 1999)
    return warehouse.fact_ball_events(incremental.newer_than(t.stg_balls, loaded))


def _phase_sql(phase: str, name: str) -> str:
    return f"""coalesce(sum(runs_scored) FILTER (WHERE phase = '{phase}'), 0) AS {name}_runs,
      {cnt(f"phase = '{phase}' AND is_wicket")} AS {name}_wickets"""


MATCH_FACT_SQL = f"""
  SELECT m.*, coalesce(total_fours, 0) AS total_fours, coalesce(total_sixes, 0) AS total_sixes,
    coalesce(total_dot_balls, 0) AS total_dot_balls, coalesce(powerplay_runs, 0) AS powerplay_runs,
    coalesce(powerplay_wickets, 0) AS powerplay_wickets, coalesce(middle_overs_runs, 0) AS middle_overs_runs,
    coalesce(middle_overs_wickets, 0) AS middle_overs_wickets, coalesce(death_overs_runs, 0) AS death_overs_runs,
    coalesce(death_overs_wickets, 0) AS death_overs_wickets
  FROM ({STG_MATCHES_SQL}) m
  LEFT JOIN (
    SELECT match_id, {cnt("runs_scored = 4")} AS total_fours, {cnt("runs_scored = 6")} AS total_sixes,
      {DOT_ALL} AS total_dot_balls, {_phase_sql("powerplay", "powerplay")},
      {_phase_sql("middle", "middle_overs")}, {_phase_sql("death", "death_overs")}
    FROM balls GROUP BY match_id) b ON m.match_id = b.match_id"""


@query(
    "w8_fact_match_summary",
    "match_id: bigint; season: int; match_date: date; innings1_runs innings2_runs: int; "
    "innings1_run_rate: decimal(10,2); winner margin: string; total_match_runs: int; batting_first_won: boolean; "
    "total_fours total_sixes total_dot_balls powerplay_runs powerplay_wickets middle_overs_runs middle_overs_wickets "
    "death_overs_runs death_overs_wickets: bigint; _loaded_at: timestamp_ntz",
    MATCH_FACT_SQL,
)
def _(t):
    # The totals need no header column, so the deliveries go in as they are recorded.
    return warehouse.fact_match_summary(t.stg_matches, t.lines.withColumn("match_phase", m.phase()))


@query(
    "w9_player_performance",
    "season: int; match_id: bigint; player_name team: string; batting_runs balls_faced fours sixes: bigint; "
    "strike_rate: double; was_dismissed: int; wickets runs_conceded: bigint; overs_bowled economy_rate: double; "
    "bowling_dot_balls: bigint; fantasy_points: double",
    f"""SELECT coalesce(a.season, b.season) AS season, match_id, player_name, coalesce(a.team, b.team) AS team,
          coalesce(runs, 0) AS batting_runs, coalesce(faced, 0) AS balls_faced, coalesce(fours, 0) AS fours,
          coalesce(sixes, 0) AS sixes, coalesce(strike_rate, 0) AS strike_rate, coalesce(out, 0) AS was_dismissed,
          coalesce(wickets, 0) AS wickets, coalesce(conceded, 0) AS runs_conceded, coalesce(overs, 0) AS overs_bowled,
          coalesce(economy, 0) AS economy_rate, coalesce(dots, 0) AS bowling_dot_balls,
          coalesce(runs, 0) + coalesce(fours, 0) + 2 * coalesce(sixes, 0) + 25 * coalesce(wickets, 0)
            + CASE WHEN runs >= 50 THEN 25 ELSE 0 END + CASE WHEN runs >= 100 THEN 50 ELSE 0 END
            + CASE WHEN wickets >= 3 THEN 25 ELSE 0 END AS fantasy_points
        FROM (SELECT match_id, batsman AS player_name, min(season) AS season, min(batting_team) AS team,
                sum(runs_scored) AS runs, count(*) AS faced, {cnt("runs_scored = 4")} AS fours,
                {cnt("runs_scored = 6")} AS sixes, {r("100 * sum(runs_scored) / count(*)")} AS strike_rate,
                max(CASE WHEN is_wicket THEN 1 ELSE 0 END) AS out
              FROM balls GROUP BY 1, 2) a
        FULL JOIN (SELECT match_id, bowler AS player_name, min(season) AS season, min(bowling_team) AS team,
                {cnt("is_wicket")} AS wickets, sum(runs_scored) AS conceded, {r("count(*) / 6", 1)} AS overs,
                {economy_sql("sum(runs_scored)", "count(*)")} AS economy, {DOT_ALL} AS dots
              FROM balls GROUP BY 1, 2) b USING (match_id, player_name)""",
)
def _(t):
    return warehouse.fact_player_performance(t.stg_balls)


@query(
    "i1_merge_upsert",
    "match_id: bigint; season innings1_runs: int; _loaded_at: timestamp_ntz",
    """SELECT match_id, season, innings1_runs + CASE WHEN date >= DATE '1998-01-01' THEN 2 ELSE 0 END AS innings1_runs,
         opened AS _loaded_at FROM matches""",
)
def _(t):
    # The table holds matches up to 1998; a reload from 1998 on arrives twice with corrected scores,
    # and the later correction must win.
    rows = t.stg_matches.select("match_id", "season", "innings1_runs", "_loaded_at", "match_date")
    target = rows.where(F.col("match_date") < "1999-01-01").withColumn("version", F.lit(0))
    reload = rows.where(F.col("match_date") >= "1998-01-01")
    fixes = [
        reload.withColumns({"innings1_runs": F.col("innings1_runs") + n, "version": F.lit(n)}) for n in (1, 2)
    ]
    return incremental.merge_rows(target, fixes[0].unionByName(fixes[1]), ["match_id"], "version")


SCD_COLUMNS = (
    "team_name: string; total_matches total_wins: bigint; win_percentage: double; valid_from valid_to: timestamp_ntz"
)


def _record_before(day: str) -> str:
    return f"""
      SELECT team AS team_name, count(*) AS total_matches, {cnt("winner = team")} AS total_wins,
        {r("100 * count(*) FILTER (WHERE winner = team) / count(*)")} AS win_percentage
      FROM sides JOIN (SELECT match_id, date FROM header) USING (match_id)
      WHERE date < DATE '{day}' GROUP BY team"""


@query(
    "i2_team_history",
    SCD_COLUMNS,
    f"""WITH a AS ({_record_before("1995-02-01")}), b AS ({_record_before("1998-01-01")}),
          c AS ({_record_before("2002-01-01")}),
          v AS (SELECT *, 1 AS n, TIMESTAMP '1995-02-01' AS since FROM a
                UNION ALL SELECT *, 2, TIMESTAMP '1998-01-01' FROM b
                UNION ALL SELECT *, 3, TIMESTAMP '2002-01-01' FROM c),
          changed AS (
            SELECT *, lag(total_matches) OVER w IS DISTINCT FROM total_matches
                OR lag(total_wins) OVER w IS DISTINCT FROM total_wins AS is_new
            FROM v WINDOW w AS (PARTITION BY team_name ORDER BY n))
        SELECT team_name, total_matches, total_wins, win_percentage, since AS valid_from,
          lead(since) OVER (PARTITION BY team_name ORDER BY n) AS valid_to
        FROM changed WHERE is_new""",
)
def _(t):
    history = None
    for day in ("1995-02-01", "1998-01-01", "2002-01-01"):
        snapshot = warehouse.team_record(t.stg_matches.where(F.col("match_date") < day)).select(
            "team_name", "total_matches", "total_wins", "win_percentage"
        )
        at = F.lit(day).cast("timestamp_ntz")
        check = ["total_matches", "total_wins", "win_percentage"]
        history = incremental.scd2(history, snapshot, "team_name", check, at)
    return history


@query(
    "i1_apply_changes",
    "match_id: bigint; season innings1_runs version: int",
    """SELECT match_id, season, innings1_runs + version AS innings1_runs, CAST(version AS INTEGER) AS version
       FROM (SELECT match_id, season, innings1_runs, CASE WHEN match_id % 3 = 0 THEN 2 WHEN match_id % 5 = 0 THEN 1 ELSE 0 END AS version
         FROM matches WHERE NOT (match_id % 7 = 0 AND match_id % 3 <> 0))""",
)
def _(t):
    # First loads, a first correction of some, deletions of some, and a second correction that brings rows back.
    rows = t.stg_matches.select("match_id", "season", "innings1_runs")

    def feed(where, version, gone):
        runs = (F.col("innings1_runs") + version).alias("innings1_runs")
        more = F.lit(2 * version + int(gone)).alias("sequence"), F.lit(gone).alias("gone"), F.lit(version).alias("version")
        return rows.where(where).select("match_id", "season", runs, *more)

    newest_first = [
        feed("match_id % 3 = 0", 2, False), feed("match_id % 7 = 0", 1, True), feed("match_id % 5 = 0", 1, False), feed("true", 0, False),
    ]
    changes = newest_first[0]
    for part in newest_first[1:]:
        changes = changes.unionByName(part)
    return incremental.apply_changes(changes, ["match_id"], "sequence", F.col("gone"))


LATE_HISTORY_SQL = f"""
  WITH v AS (
    SELECT *, TIMESTAMP '1995-02-01' AS since FROM ({_record_before("1995-02-01")})
    UNION ALL SELECT *, TIMESTAMP '1996-06-01' FROM ({_record_before("1996-06-01")})
    UNION ALL SELECT *, TIMESTAMP '1998-01-01' FROM ({_record_before("1998-01-01")})
    UNION ALL SELECT *, TIMESTAMP '2002-01-01' FROM ({_record_before("2002-01-01")})),
  changed AS (
    SELECT *, lag(total_matches) OVER w IS DISTINCT FROM total_matches OR lag(total_wins) OVER w IS DISTINCT FROM total_wins AS is_new
    FROM v WINDOW w AS (PARTITION BY team_name ORDER BY since))
  SELECT team_name, total_matches, total_wins, win_percentage, since AS valid_from,
    lead(since) OVER (PARTITION BY team_name ORDER BY since) AS valid_to
  FROM changed WHERE is_new"""


def _late_history(t):
    """Team records of three days, and then that of a day between them."""
    check, history = ["total_matches", "total_wins", "win_percentage"], None
    day_of = lambda day: F.lit(day).cast("timestamp_ntz")
    record = lambda day: warehouse.team_record(t.stg_matches.where(F.col("match_date") < day)).select("team_name", *check)
    for day in ("1995-02-01", "1998-01-01", "2002-01-01"):
        history = incremental.scd2(history, record(day), "team_name", check, day_of(day))
    return incremental.with_late_snapshot(
        history, record("1996-06-01"), "team_name", check, day_of("1996-06-01"), day_of("1998-01-01")
    )


@query("i2_late_snapshot", SCD_COLUMNS, LATE_HISTORY_SQL)
def _(t):
    return _late_history(t)


@query(
    "i2_matches_as_of",
    "match_id: bigint; season: int; team1: string; then_total_matches then_total_wins: bigint; then_win_percentage: double",
    f"""SELECT h.match_id, h.season, h.team1, total_matches AS then_total_matches, total_wins AS then_total_wins,
          win_percentage AS then_win_percentage
        FROM header h LEFT JOIN ({LATE_HISTORY_SQL}) s
          ON h.team1 = s.team_name AND h.date >= s.valid_from AND (s.valid_to IS NULL OR h.date < s.valid_to)""",
)
def _(t):
    facts = t.stg_matches.select("match_id", "season", "team1", F.col("match_date").cast("timestamp_ntz").alias("played"))
    values = ["total_matches", "total_wins", "win_percentage"]
    return incremental.as_of(facts, _late_history(t), "team1", "played", "team_name", values)


CAREER_SQL = f"""
  SELECT player_id, p.player_name, nationality, role, coalesce(matches_played, 0) AS matches_played,
    coalesce(total_runs, 0) AS total_runs, coalesce(fours, 0) AS fours, coalesce(sixes, 0) AS sixes,
    coalesce(batting_average, 0) AS batting_average, coalesce(strike_rate, 0) AS strike_rate,
    coalesce(total_wickets, 0) AS total_wickets, coalesce(economy_rate, 0) AS economy_rate
  FROM players p
  LEFT JOIN (
    SELECT batsman, count(DISTINCT match_id) AS matches_played, sum(runs_scored) AS total_runs,
      {cnt("runs_scored = 4")} AS fours, {cnt("runs_scored = 6")} AS sixes,
      {r("sum(runs_scored) / greatest(count(*) FILTER (WHERE is_wicket), 1)")} AS batting_average,
      {r("100 * sum(runs_scored) / count(*)")} AS strike_rate
    FROM balls WHERE {{season}} GROUP BY 1) b ON p.player_name = b.batsman
  LEFT JOIN (
    SELECT bowler, {cnt("is_wicket")} AS total_wickets, {r("6 * sum(runs_scored) / count(*)")} AS economy_rate
    FROM balls WHERE {{season}} GROUP BY 1) w ON p.player_name = w.bowler"""
CAREER_COLUMNS = (
    "player_id: bigint; player_name nationality role: string; matches_played total_runs fours sixes: bigint; "
    "batting_average strike_rate: double; total_wickets: bigint; economy_rate: double"
)


def career(season: str = "TRUE") -> str:
    return CAREER_SQL.format(season=season)


@query(
    "r1_player_listing",
    CAREER_COLUMNS + "; total: bigint",
    f"""SELECT *, count(*) OVER () AS total FROM ({career()}) WHERE lower(role) = 'bowler'
        ORDER BY total_runs DESC, player_id LIMIT 20""",
)
def _(t):
    return serving.get_players(t.players, t.balls, sort_by="total_runs", role="BOWLER")


@query(
    "r2_second_page",
    CAREER_COLUMNS + "; total: bigint",
    f"SELECT *, count(*) OVER () AS total FROM ({career()}) ORDER BY batting_average DESC, player_id LIMIT 15 OFFSET 15",
)
def _(t):
    return serving.get_players(t.players, t.balls, page=2, per_page=15, sort_by="batting_average")


MATCH_ROW = "match_id: bigint; season: int; date: date; team1 team2 winner margin venue: string"


@query(
    "r2_page_past_end",
    "total rows_on_page: bigint",
    f"SELECT count(*) AS total, CAST(0 AS BIGINT) AS rows_on_page FROM ({career()})",
)
def _(t):
    beyond = serving.get_players(t.players, t.balls, page=1_000_000)
    on_page = beyond.agg(F.count("*")).scalar()
    return serving.count_players(t.players, t.balls).withColumn("rows_on_page", on_page)


@query(
    "r3_match_listing",
    MATCH_ROW + "; total: bigint",
    """SELECT *, count(*) OVER () AS total FROM matches WHERE season = 1997 AND ('T3' IN (team1, team2))
       ORDER BY date DESC, match_id LIMIT 20""",
)
def _(t):
    return serving.get_matches(t.matches, season=1997, team="t3")


TEAM_SQL = f"""
  SELECT team AS team_name, count(*) AS matches_played, {cnt("winner = team")} AS wins,
    count(*) - count(*) FILTER (WHERE winner = team) AS losses,
    {r("100 * count(*) FILTER (WHERE winner = team) / count(*)")} AS win_percentage,
    count(DISTINCT season) AS seasons_played
  FROM sides GROUP BY team"""
TEAM_COLUMNS = "team_name: string; matches_played wins losses: bigint; win_percentage: double; seasons_played: bigint"


@query("r4_team_stats", TEAM_COLUMNS, TEAM_SQL)
def _(t):
    return serving.team_stats(t.matches)


HEAD_COLUMNS = "; ".join(
    f"team{n}_name: string; team{n}_matches_played team{n}_wins team{n}_losses: bigint; "
    f"team{n}_win_percentage: double; team{n}_seasons_played: bigint"
    for n in (1, 2)
) + "; meetings head_to_head_team1_wins head_to_head_team2_wins: bigint"


def head_to_head_sql(a: str, b: str) -> str:
    def side(n: int, name: str) -> str:
        fields = ("matches_played", "wins", "losses", "win_percentage", "seasons_played")
        kept = ", ".join(f"coalesce(max({f}), 0) AS team{n}_{f}" for f in fields)
        return f"(SELECT '{name}' AS team{n}_name, {kept} FROM ({TEAM_SQL}) WHERE team_name = '{name}')"

    return f"""SELECT * FROM {side(1, a)}, {side(2, b)}, (
        SELECT count(*) AS meetings, {cnt(f"winner = '{a}'")} AS head_to_head_team1_wins,
          {cnt(f"winner = '{b}'")} AS head_to_head_team2_wins
        FROM matches WHERE '{a}' IN (team1, team2) AND '{b}' IN (team1, team2))"""


@query("r5_head_to_head", HEAD_COLUMNS, head_to_head_sql("T3", "T5"))
def _(t):
    return serving.head_to_head(t.matches, "t3", "T5")


@query("r5_head_to_head_unknown", HEAD_COLUMNS, head_to_head_sql("T3", "nobody"))
def _(t):
    return serving.head_to_head(t.matches, "T3", "nobody", match="exact")


VENUE_SQL = f"""
  SELECT venue AS venue_name, min(city) AS city, count(*) AS matches_hosted,
    {r("sum(innings1_runs) / count(*)", 1)} AS avg_first_innings,
    {r("sum(innings2_runs) / count(*)", 1)} AS avg_second_innings,
    {r("100 * count(*) FILTER (WHERE result_type = 'runs') / count(*)")} AS bat_first_win_pct,
    {r("100 * (count(*) - count(*) FILTER (WHERE result_type = 'runs')) / count(*)")} AS chase_win_pct
  FROM matches GROUP BY venue"""
VENUE_COLUMNS = (
    "venue_name city: string; matches_hosted: bigint; "
    "avg_first_innings avg_second_innings bat_first_win_pct chase_win_pct: double"
)


@query("r6_venue_stats", VENUE_COLUMNS, VENUE_SQL)
def _(t):
    return serving.venue_stats(t.matches)


@query(
    "r7_season_summary",
    "season: int; matches total_runs: bigint; avg_runs_per_match: double",
    f"""SELECT season, count(*) AS matches, sum(total_runs) AS total_runs,
          {r("sum(total_runs) / count(*)", 1)} AS avg_runs_per_match FROM matches GROUP BY season""",
)
def _(t):
    return serving.season_summary(t.matches)


@query(
    "r8_extended_season_summary",
    "season: int; total_matches total_runs: bigint; avg_runs_per_match: double; total_sixes total_fours: bigint; "
    "highest_team_score lowest_team_score: int",
    f"""SELECT * FROM (
          SELECT season, count(*) AS total_matches, sum(total_runs) AS total_runs,
            {r("sum(total_runs) / count(*)", 1)} AS avg_runs_per_match,
            max(greatest(innings1_runs, innings2_runs)) AS highest_team_score,
            min(least(innings1_runs, innings2_runs)) AS lowest_team_score FROM matches GROUP BY season)
        JOIN (SELECT season, {cnt("runs_scored = 6")} AS total_sixes, {cnt("runs_scored = 4")} AS total_fours
              FROM balls GROUP BY season) USING (season)""",
)
def _(t):
    return serving.extended_season_summary(t.matches, t.balls)


@query("r9_recent_matches", MATCH_ROW, "SELECT * FROM matches ORDER BY date DESC, match_id LIMIT 10")
def _(t):
    return serving.recent_matches(t.matches, 10)


@query(
    "r10_top_batsmen",
    CAREER_COLUMNS,
    f"SELECT * FROM ({career('season = 1998')}) ORDER BY total_runs DESC, player_id LIMIT 10",
)
def _(t):
    return serving.top_batsmen(t.players, t.balls, 10, season=1998)


@query(
    "r11_top_bowlers",
    CAREER_COLUMNS,
    f"SELECT * FROM ({career()}) WHERE role = 'Bowler' ORDER BY total_wickets DESC, player_id LIMIT 10",
)
def _(t):
    return serving.top_bowlers(t.players, t.balls, 10)


@query(
    "r12_strike_rate_leaders",
    CAREER_COLUMNS,
    f"SELECT * FROM ({career()}) WHERE total_runs >= 100 ORDER BY strike_rate DESC, player_id LIMIT 10",
)
def _(t):
    return serving.strike_rate_leaders(t.players, t.balls, 10, 100)


@query(
    "r13_team_rankings",
    "rank: bigint; " + TEAM_COLUMNS,
    f"SELECT row_number() OVER (ORDER BY win_percentage DESC, team_name) AS rank, * FROM ({TEAM_SQL})",
)
def _(t):
    return serving.team_rankings(t.matches)


@query(
    "r14_best_batting_venues",
    VENUE_COLUMNS,
    f"SELECT * FROM ({VENUE_SQL}) ORDER BY avg_first_innings DESC, venue_name LIMIT 5",
)
def _(t):
    return serving.best_batting_venues(t.matches)


@query(
    "r14_chase_friendly_venues",
    VENUE_COLUMNS,
    f"SELECT * FROM ({VENUE_SQL}) ORDER BY chase_win_pct DESC, venue_name LIMIT 5",
)
def _(t):
    return serving.chase_friendly_venues(t.matches)


RESULT = "check dataset field: string; failures total: bigint; passed: boolean"


@query(
    "k1_null_check",
    RESULT + "; failure_pct: double",
    "\nUNION ALL ".join(
        f"""SELECT 'null_check' AS check, 'matches' AS dataset, '{f}' AS field,
              count(*) - count({f}) AS failures, count(*) AS total, count(*) = count({f}) AS passed,
              {r(f"100 * (count(*) - count({f})) / count(*)", 1)} AS failure_pct FROM matches"""
        for f in ("match_id", "season", "team1", "team2", "winner", "venue", "date")
    ),
)
def _(t):
    return quality.null_check(t.raw_matches, "matches", quality.RAW_RULES["matches"].required)


@query(
    "k2_duplicate_check",
    RESULT + "; unique_keys: bigint",
    """SELECT 'duplicate_check' AS check, 'events' AS dataset, 'match_id' AS field,
         count(*) - count(DISTINCT match_id) AS failures, count(*) AS total, FALSE AS passed,
         count(DISTINCT match_id) AS unique_keys FROM live""",
)
def _(t):
    return quality.duplicate_check(t.live, "events", "match_id")


@query(
    "k3_schema_check",
    RESULT,
    """SELECT 'schema_check' AS "check", 'orders' AS dataset, unnest(['o_orderkey', 'o_orderdate', 'venue']) AS field,
         unnest([0, 0, count(*)]) AS failures, count(*) AS total, unnest([TRUE, TRUE, FALSE]) AS passed FROM orders
       UNION ALL
       SELECT 'type_check', 'orders', unnest(['o_totalprice', 'o_orderpriority']),
         unnest([0, count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS DOUBLE) IS NULL)]), count(*),
         unnest([TRUE, FALSE]) FROM orders""",
)
def _(t):
    expected = ["o_orderkey", "o_orderdate", "venue"]
    return quality.schema_check(t.source("orders"), "orders", expected, ["o_totalprice", "o_orderpriority"])


@query(
    "k4_freshness",
    RESULT + "; age_hours: double",
    f"""SELECT 'freshness_check' AS "check", 'events' AS dataset, 'event_time' AS field, 1 AS failures,
          count(*) AS total, FALSE AS passed,
          {r("(epoch_us(TIMESTAMP '2024-02-02') - epoch_us(max(ts))) / 1000000 / 3600")} AS age_hours FROM live""",
)
def _(t):
    return quality.freshness_check(t.live, "events", 48, "event_time", F.lit("2024-02-02").cast("timestamp"))


@query(
    "k6_report",
    RESULT,
    "\nUNION ALL ".join(
        [
            f"""SELECT 'null_check' AS "check", '{d}' AS dataset, '{f}' AS field, count(*) - count({f}) AS failures,
                  count(*) AS total, count(*) = count({f}) AS passed FROM {source}"""
            for d, source, fields in (
                ("matches", "matches", "match_id season team1 team2 winner venue date"),
                ("players", "players", "player_id player_name nationality role"),
                ("ball_events", "balls", "match_id innings over ball batsman bowler runs_scored"),
            )
            for f in fields.split()
        ]
        + [
            f"""SELECT '{check}', '{d}', '{f}', 0, count(*), TRUE FROM {d}"""
            for check, d, fields in (
                (
                    "schema_check",
                    "matches",
                    "match_id season date venue city team1 team2 winner toss_winner toss_decision innings1_runs "
                    "innings2_runs",
                ),
                ("type_check", "matches", "season innings1_runs innings2_runs"),
                ("duplicate_check", "matches", "match_id"),
                ("schema_check", "players", "player_id player_name nationality batting_style bowling_style role"),
                ("duplicate_check", "players", "player_id"),
            )
            for f in fields.split()
        ]
    ),
)
def _(t):
    tables = {"matches": t.raw_matches, "players": t.players, "ball_events": t.balls}
    return quality.raw_checks(tables, max_age_hours=None)


@query(
    "k8_not_null",
    RESULT,
    "\nUNION ALL ".join(
        f"""SELECT 'not_null' AS check, 'stg_matches' AS dataset, '{f}' AS field, {cnt(f"{f} IS NULL")} AS failures,
              count(*) AS total, count(*) = count({f}) AS passed FROM matches"""
        for f in ("match_id", "season", "winner")
    ),
)
def _(t):
    return quality.not_null(t.stg_matches, "stg_matches", quality.NOT_NULL["stg_matches"])


@query(
    "k9_unique",
    "value: string; occurrences: bigint",
    """SELECT l_orderkey || '-' || l_linenumber AS value, count(*) AS occurrences
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(t):
    keyed = t.source("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"))
    return quality.unique_violations(keyed, "line_id")


@query(
    "k10_relationships",
    "value occurrences: bigint",
    """SELECT match_id AS value, count(*) AS occurrences FROM lines
       WHERE match_id NOT IN (SELECT match_id FROM live) GROUP BY match_id""",
)
def _(t):
    return quality.orphans(t.lines, "match_id", t.live, "match_id")


@query(
    "k10_relationship_check",
    "check dataset field: string; failures total: bigint; passed: boolean",
    """SELECT 'relationships' AS "check", 'deliveries' AS dataset, 'match_id' AS field, count(*) FILTER (WHERE lost) AS failures,
         count(*) AS total, count(*) FILTER (WHERE lost) = 0 AS passed
       FROM (SELECT match_id NOT IN (SELECT match_id FROM live) AS lost FROM lines)""",
)
def _(t):
    return quality.relationships(t.lines, "deliveries", "match_id", t.live, "match_id")


@query(
    "k11_positive_value",
    "invalid_value: int; occurrences: bigint",
    """SELECT innings1_runs - innings2_runs AS invalid_value, count(*) AS occurrences FROM matches
       WHERE innings1_runs < innings2_runs GROUP BY 1""",
)
def _(t):
    lead = F.col("innings1_runs") - F.col("innings2_runs")
    return quality.positive_value(t.raw_matches.withColumn("lead", lead), "lead")


@query(
    "t1_decode_payload",
    "k: int; kafka_timestamp: timestamp_ntz",
    "SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, ts AS kafka_timestamp FROM live",
)
def _(t):
    raw = t.live.select(F.col("props").alias("value"), F.col("event_time").alias("timestamp"))
    return live.decode(raw, StructType([StructField("k", IntegerType())]))


@query(
    "t1_decode_all_fields",
    "event_id match_id timestamp: string; innings over ball: int; batting_team bowling_team batsman bowler: string; "
    "runs_scored: int; is_wicket: boolean; dismissal_type: string; is_boundary: boolean; total_runs total_wickets: int; "
    "run_rate: double; is_powerplay is_death_overs: boolean; phase venue city match_state: string; "
    "kafka_timestamp: timestamp_ntz",
    """SELECT * EXCLUDE (match_id), CAST(match_id AS VARCHAR) AS match_id, props AS timestamp, runs_scored IN (4, 6) AS is_boundary,
         over < 6 AS is_powerplay, over > 15 AS is_death_overs, 'p' || over AS phase, batting_team AS venue,
         bowling_team AS city, CASE WHEN ball > 2 THEN 'live' END AS match_state, ts AS kafka_timestamp
       FROM live""",
)
def _(t):
    filled = t.live.withColumns(
        {
            "timestamp": F.col("props"),
            "is_boundary": F.col("runs_scored").isin(4, 6),
            "is_powerplay": F.col("over") < 6,
            "is_death_overs": F.col("over") > 15,
            "phase": F.concat(F.lit("p"), "over"),
            "venue": F.col("batting_team"),
            "city": F.col("bowling_team"),
            "match_state": F.when(F.col("ball") > 2, "live"),
        }
    )
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LIVE_BALL_EVENT.fields]
    return live.decode(filled.select(F.to_json(F.struct(*fields)).alias("value"), F.col("event_time").alias("timestamp")))


WINDOW_COLUMNS = (
    "window_start window_end: timestamp_ntz; match_id: bigint; innings: int; batting_team: string; "
    "runs_in_window balls_in_window wickets_in_window fours sixes: bigint; current_total current_wickets: int; "
    "current_run_rate: double"
)
WINDOW_SQL = f"""
  SELECT make_timestamp(start * 1000000) AS window_start, make_timestamp((start + 60) * 1000000) AS window_end,
          match_id, innings, batting_team, sum(runs_scored) AS runs_in_window, count(*) AS balls_in_window,
          {cnt("is_wicket")} AS wickets_in_window, {cnt("runs_scored = 4")} AS fours,
          {cnt("runs_scored = 6")} AS sixes, max(total_runs) AS current_total, max(total_wickets) AS current_wickets,
          max(run_rate) AS current_run_rate
        FROM (SELECT *, unnest([CAST(floor(epoch(ts) / 30) * 30 AS BIGINT),
                                CAST(floor(epoch(ts) / 30) * 30 - 30 AS BIGINT)]) AS start FROM live)
        GROUP BY start, match_id, innings, batting_team"""


@query("t3_window_stats", WINDOW_COLUMNS, WINDOW_SQL)
def _(t):
    return live.window_stats(t.live, "event_time")


@query("t5_window_upsert", WINDOW_COLUMNS, WINDOW_SQL)
def _(t):
    # A first batch saw the events up to mid-month, the next one all; upserting both gives the whole.
    keys = ["window_start", *live.WINDOW_KEYS]
    day = F.col("event_time") < F.lit("2024-01-15").cast("timestamp")
    batches = [live.window_stats(events, "event_time") for events in (t.live.where(day), t.live)]
    stored, arriving = (b.withColumn("_batch", F.lit(n)) for n, b in enumerate(batches))
    return incremental.merge_rows(stored, arriving, keys, "_batch")


@query(
    "t8_fan_out",
    "feed: string; match_id: bigint; innings total_wickets: int; detail: string",
    """SELECT 'score' AS feed, match_id, innings, total_wickets, batting_team AS detail FROM live
       UNION ALL SELECT 'wicket', match_id, innings, total_wickets, dismissal_type FROM live WHERE is_wicket
       UNION ALL SELECT 'state', match_id, innings, total_wickets, 'in_progress' FROM live""",
)
def _(t):
    events = t.live.withColumns({"timestamp": F.col("event_time").cast("string"), "match_state": F.lit(None).cast("string")})
    feeds = live.fan_out(events)
    detail = {"score": "batting_team", "wicket": "dismissal_type", "state": "match_state"}
    out = None
    for feed, column in detail.items():
        part = feeds[feed].select(
            F.lit(feed).alias("feed"), "match_id", "innings", "total_wickets", F.col(column).alias("detail")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "t9_latest_state",
    "match_id: bigint; event_id: string; innings over ball total_runs total_wickets: int",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id
           ORDER BY innings DESC, over DESC, ball DESC, event_id DESC) AS rn FROM live) WHERE rn = 1""",
)
def _(t):
    states = t.live.select("match_id", "event_id", "innings", "over", "ball", "total_runs", "total_wickets")
    return live.latest_state(states, ("innings", "over", "ball", "event_id"))


# Exact below 2^lg players, an estimate beyond; the SQL counts exactly.
@query(
    "k2_distinct_players_by_sketch",
    "season: int; batsman bowler: bigint",
    """SELECT season, count(DISTINCT batsman) AS batsman, count(DISTINCT bowler) AS bowler FROM balls GROUP BY season
       UNION ALL SELECT NULL, count(DISTINCT batsman), count(DISTINCT bowler) FROM balls""",
)
def _(t):
    names, lg = ["batsman", "bowler"], 20
    seasons = sketches.distinct_sketches(t.balls, ["season"], names, lg)
    whole = sketches.merge_distinct(seasons, [], names, lg).withColumn("season", F.lit(None).cast("int"))
    return sketches.distinct_counts(seasons.unionByName(whole), names)


@query(
    "t1_payload_fields",
    "field type: string; payloads: bigint",
    """SELECT field, CASE json_type(props, '$.' || field) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING'
         ELSE json_type(props, '$.' || field) END AS type, count(*) AS payloads
       FROM (SELECT props, unnest(json_keys(props)) AS field FROM events WHERE props IS NOT NULL) GROUP BY 1, 2""",
)
def _(t):
    return payloads.fields(payloads.with_variant(t.source("events"), "props"))
