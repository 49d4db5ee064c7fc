"""Registered queries: the dashboard tables."""


from matchlake.functions import metrics as m
from matchlake.functions import scoring
from matchlake.operators import insights, state
from matchlake.plans.base import cnt, query, r
from matchlake.plans.lake import STATE_SQL

BAT = f"""
  SELECT batsman, sum(runs_scored) AS runs, count(*) AS balls, {cnt("runs_scored = 4")} AS fours,
    {cnt("runs_scored = 6")} AS sixes, {cnt("runs_scored IN (4, 6)")} AS boundaries,
    count(DISTINCT match_id) AS matches, {r("100 * sum(runs_scored) / count(*)")} AS strike_rate,
    {r("sum(runs_scored) / count(DISTINCT match_id)")} AS avg,
    {r("100 * count(*) FILTER (WHERE runs_scored IN (4, 6)) / count(*)")} AS boundary_pct
  FROM balls WHERE {{where}} GROUP BY batsman"""
BOWL = f"""
  SELECT bowler, count(*) AS balls, sum(runs_scored) AS runs_conceded, {cnt("is_wicket")} AS wickets,
    count(DISTINCT match_id) AS matches, {r("6 * sum(runs_scored) / count(*)")} AS economy,
    {r("count(*) / 6", 1)} AS overs
  FROM balls GROUP BY bowler"""
RECENT = "date: date; team1 team2 winner margin venue: string"


@query(
    "d1_match_kpis",
    "total_matches: bigint; avg_runs_per_match: double; seasons: bigint; most_wins: string",
    f"""SELECT count(*) AS total_matches, {r("sum(total_runs) / count(*)", 0)} AS avg_runs_per_match,
          count(DISTINCT season) AS seasons,
          (SELECT winner FROM matches WHERE winner IS NOT NULL GROUP BY winner ORDER BY count(*) DESC, winner LIMIT 1)
            AS most_wins
        FROM matches""",
)
def _(t):
    return insights.match_kpis(t.matches)


@query(
    "d2_player_kpis",
    "unique_players total_runs total_sixes total_fours: bigint",
    f"""SELECT count(DISTINCT batsman) AS unique_players, sum(runs_scored) AS total_runs,
          {cnt("runs_scored = 6")} AS total_sixes, {cnt("runs_scored = 4")} AS total_fours FROM balls""",
)
def _(t):
    return insights.player_kpis(t.balls)


@query(
    "d3_live_kpis",
    "ball_id score_line: string; run_rate: double; runs_needed: bigint; projected: int",
    f"""SELECT ball_id, total_runs || '/' || total_wickets AS score_line, run_rate, runs_needed,
          CASE WHEN target IS NULL THEN trunc(run_rate * 20) END AS projected
        FROM (SELECT * REPLACE (CASE WHEN target IS NOT NULL THEN runs_needed END AS runs_needed) FROM ({STATE_SQL}))""",
)
def _(t):
    return scoring.live_indicators(state.with_run_rate(state.running_state(t.lines)))


@query(
    "d4_team_wins",
    "team: string; wins: bigint",
    "SELECT winner AS team, count(*) AS wins FROM matches WHERE winner IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(t):
    return insights.team_wins(t.matches)


@query(
    "d5_season_runs",
    "season: int; total_runs matches: bigint; avg_runs: double",
    """SELECT season, sum(total_runs) AS total_runs, count(*) AS matches, sum(total_runs) / count(*) AS avg_runs
       FROM matches GROUP BY season""",
)
def _(t):
    return insights.season_runs(t.matches)


@query(
    "d6_busiest_venues",
    "venue: string; matches: bigint; avg_i1: double",
    """SELECT venue, count(*) AS matches, sum(innings1_runs) / count(*) AS avg_i1 FROM matches
       GROUP BY venue ORDER BY matches DESC, venue LIMIT 10""",
)
def _(t):
    return insights.busiest_venues(t.matches)


@query(
    "d7_toss_win_rate",
    "toss_decision: string; win_rate: double",
    f"SELECT toss_decision, 100 * {cnt('toss_winner = winner')} / count(*) AS win_rate FROM matches GROUP BY 1",
)
def _(t):
    return insights.toss_win_rate(t.matches)


@query(
    "d8_top_scorers",
    "player: string; runs: bigint",
    "SELECT batsman AS player, sum(runs_scored) AS runs FROM balls GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(t):
    return insights.top_scorers(t.balls)


@query(
    "d9_phase_rates",
    "phase: string; total_runs total_balls wickets: bigint; run_rate: double",
    f"""SELECT phase, sum(runs_scored) AS total_runs, count(*) AS total_balls, {cnt("is_wicket")} AS wickets,
          6 * sum(runs_scored) / count(*) AS run_rate FROM balls GROUP BY phase""",
)
def _(t):
    return insights.phase_rates(t.lines.withColumn("phase", m.phase()))


@query(
    "d10_season_counts", "season: int; matches: bigint", "SELECT season, count(*) AS matches FROM matches GROUP BY season"
)
def _(t):
    return insights.season_match_counts(t.matches)


@query("d10_recent_results", RECENT, "SELECT * FROM matches ORDER BY date DESC, match_id LIMIT 10")
def _(t):
    return insights.recent_results(t.matches)


@query(
    "d11_batting_leaderboard",
    "batsman: string; runs balls fours sixes matches: bigint; strike_rate avg: double",
    f"SELECT * FROM ({BAT.format(where='TRUE')}) ORDER BY runs DESC, batsman LIMIT 20",
)
def _(t):
    return insights.batting_leaderboard(t.balls)


@query(
    "d12_bowling_leaderboard",
    "bowler: string; balls runs_conceded wickets matches: bigint; economy overs: double",
    f"SELECT * FROM ({BOWL}) ORDER BY wickets DESC, bowler LIMIT 20",
)
def _(t):
    return insights.bowling_leaderboard(t.balls)


@query(
    "d13_all_rounders",
    "player: string; runs wickets: bigint",
    f"""SELECT batsman AS player, runs, wickets FROM ({BAT.format(where="TRUE")}) a JOIN ({BOWL}) b ON a.batsman = b.bowler
        WHERE runs > 50 AND wickets > 2 ORDER BY runs DESC, player LIMIT 20""",
)
def _(t):
    return insights.all_rounders(t.balls)


@query(
    "d14_player_totals",
    "player: string; batting_runs balls_faced bowling_wickets matches: bigint; strike_rate: double",
    f"""SELECT 'T3-4' AS player, coalesce(sum(runs_scored) FILTER (WHERE batsman = 'T3-4'), 0) AS batting_runs,
          {cnt("batsman = 'T3-4'")} AS balls_faced, {cnt("bowler = 'T3-4' AND is_wicket")} AS bowling_wickets,
          count(DISTINCT match_id) FILTER (WHERE batsman = 'T3-4') AS matches,
          {r("100 * coalesce(sum(runs_scored) FILTER (WHERE batsman = 'T3-4'), 0) / greatest(" + cnt("batsman = 'T3-4'") + ", 1)")}
            AS strike_rate
        FROM balls""",
)
def _(t):
    return insights.player_totals(t.balls, "T3-4")


@query(
    "d14_player_seasons",
    "season: int; runs_scored: bigint",
    "SELECT season, sum(runs_scored) AS runs_scored FROM balls WHERE batsman = 'T3-4' GROUP BY season",
)
def _(t):
    return insights.player_runs_by_season(t.balls, "T3-4")


@query(
    "d15_team_seasons",
    "season: int; total wins losses: bigint; win_pct: double",
    f"""SELECT season, count(*) AS total, {cnt("winner = 'T3'")} AS wins,
          count(*) - count(*) FILTER (WHERE winner = 'T3') AS losses,
          100 * count(*) FILTER (WHERE winner = 'T3') / count(*) AS win_pct
        FROM matches WHERE 'T3' IN (team1, team2) AND season IN (1996, 1997, 1998) GROUP BY season""",
)
def _(t):
    return insights.team_seasons(t.matches, "T3", (1996, 1997, 1998))


@query(
    "d16_toss_conversion",
    "tosses_won won_after_toss lost_after_toss: bigint",
    f"""SELECT count(*) AS tosses_won, {cnt("winner = 'T3'")} AS won_after_toss,
          {cnt("winner IS DISTINCT FROM 'T3'")} AS lost_after_toss FROM matches WHERE toss_winner = 'T3'""",
)
def _(t):
    return insights.toss_conversion(t.matches, "T3")


@query(
    "d17_meeting_record",
    "total team_wins other_wins: bigint",
    f"""SELECT count(*) AS total, {cnt("winner = 'T3'")} AS team_wins, {cnt("winner = 'T5'")} AS other_wins
        FROM matches WHERE 'T3' IN (team1, team2) AND 'T5' IN (team1, team2)""",
)
def _(t):
    return insights.meeting_record(t.matches, "T3", "T5")


@query(
    "d17_team_recent",
    RECENT,
    "SELECT * FROM matches WHERE 'T3' IN (team1, team2) ORDER BY date DESC, match_id LIMIT 10",
)
def _(t):
    return insights.recent_for_team(t.matches, "T3")


@query(
    "d18_venue_table",
    "venue city: string; matches: bigint; avg_i1 avg_i2 avg_total: double",
    f"""SELECT venue, city, count(*) AS matches, {r("sum(innings1_runs) / count(*)", 1)} AS avg_i1,
          {r("sum(innings2_runs) / count(*)", 1)} AS avg_i2,
          {r("sum(innings1_runs) / count(*) + sum(innings2_runs) / count(*)", 1)} AS avg_total
        FROM matches GROUP BY venue, city""",
)
def _(t):
    return insights.venue_table(t.matches)


@query(
    "d19_venue_detail",
    "venue city: string; matches_hosted: bigint; avg_first_innings avg_second_innings: double; "
    "bat_first_wins chase_wins: bigint; bat_first_win_pct: double",
    f"""SELECT venue, min(city) AS city, count(*) AS matches_hosted,
          {r("sum(innings1_runs) / count(*)", 0)} AS avg_first_innings,
          {r("sum(innings2_runs) / count(*)", 0)} AS avg_second_innings,
          {cnt("result_type = 'runs'")} AS bat_first_wins, {cnt("result_type <> 'runs'")} AS chase_wins,
          {r("100 * count(*) FILTER (WHERE result_type = 'runs') / count(*)", 0)} AS bat_first_win_pct
        FROM matches WHERE venue = 'V3' GROUP BY venue""",
)
def _(t):
    return insights.venue_detail(t.matches, "V3")


@query(
    "d19_venue_toss",
    "toss_decision: string; win_rate: double",
    f"""SELECT toss_decision, {r("100 * count(*) FILTER (WHERE toss_winner = winner) / count(*)", 1)} AS win_rate
        FROM matches WHERE venue = 'V3' GROUP BY toss_decision""",
)
def _(t):
    return insights.venue_toss(t.matches, "V3")


@query(
    "d19_venue_recent",
    "date: date; team1 team2 winner margin player_of_match: string",
    "SELECT * FROM matches WHERE venue = 'V3' ORDER BY date DESC, match_id LIMIT 10",
)
def _(t):
    return insights.recent_at_venue(t.matches, "V3")


@query(
    "d20_score_distribution",
    "innings bin_start: int; matches: bigint",
    """SELECT innings, runs // 10 * 10 AS bin_start, count(*) AS matches FROM (
         SELECT 1 AS innings, innings1_runs AS runs FROM matches
         UNION ALL SELECT 2, innings2_runs FROM matches) GROUP BY 1, 2""",
)
def _(t):
    return insights.score_distribution(t.matches)


@query(
    "d21_dream_team",
    "role player: string; contribution: bigint; rate impact: double",
    f"""(SELECT 'batsman' AS role, batsman AS player, runs AS contribution, strike_rate AS rate,
           {r("(runs + fours + 2 * sixes) / matches", 1)} AS impact FROM ({BAT.format(where="TRUE")})
         ORDER BY (runs + fours + 2 * sixes) / matches DESC, player LIMIT 6)
        UNION ALL
        (SELECT 'bowler', bowler, wickets, economy, {r("25 * wickets / matches", 1)} FROM ({BOWL})
         ORDER BY 25 * wickets / matches DESC, bowler LIMIT 5)""",
)
def _(t):
    return insights.dream_team(t.balls)


@query(
    "d22_impact_players",
    "batsman: string; runs balls boundaries: bigint; strike_rate boundary_pct: double",
    f"""SELECT * FROM ({BAT.format(where="phase = 'death'")}) WHERE balls >= 20
        ORDER BY strike_rate DESC, batsman LIMIT 15""",
)
def _(t):
    return insights.impact_players(t.balls, "death")


@query(
    "d23_recent_deliveries",
    "match_id: bigint; innings over ball: int; batsman bowler result: string",
    """SELECT *, CASE WHEN is_wicket THEN 'WICKET! (' || dismissal_type || ')' ELSE runs_scored || ' runs' END AS result
       FROM (SELECT *, row_number() OVER (PARTITION BY match_id
               ORDER BY innings DESC, over DESC, ball DESC, ball_id DESC) AS rn FROM balls) WHERE rn <= 10""",
)
def _(t):
    return insights.recent_deliveries(t.balls)


@query(
    "d24_distinct_names",
    "kind name: string",
    """SELECT 'team' AS kind, team1 AS name FROM matches UNION SELECT 'team', team2 FROM matches
       UNION SELECT 'venue', venue FROM matches UNION SELECT 'batsman', batsman FROM balls""",
)
def _(t):
    return insights.distinct_names(t.matches, t.balls)
