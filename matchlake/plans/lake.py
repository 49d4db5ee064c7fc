"""Registered queries: scans, silver and staging, gold, match state and scoring."""

from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.functions import scoring
from matchlake.operators import gold, lines, silver, state
from matchlake.plans.base import Tables, cnt, query, r
from matchlake.sources.io import read_parquet

DOT = cnt("runs_scored = 0")


@query(
    "s2_parquet_scan",
    "l_orderkey l_partkey l_suppkey: bigint; l_linenumber: int; l_quantity l_extendedprice l_discount l_tax: double; "
    "l_returnflag l_linestatus: string; l_shipdate: timestamp_ntz",
    "SELECT * FROM lineitem",
)
def _(t: Tables):
    return read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet")


@query(
    "s2_filtered_scan",
    "l_orderkey: bigint; l_quantity: double; l_shipdate: timestamp_ntz",
    "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'",
)
def _(t: Tables):
    recent = F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    table = read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet")
    return table.where(recent).select("l_orderkey", "l_quantity", "l_shipdate")


SILVER_MATCHES = (
    "match_id: bigint; season: int; date: date; venue city team1 team2 winner: string; "
    "innings1_runs innings1_wickets: int; innings1_overs: double; innings2_runs innings2_wickets: int; "
    "innings2_overs innings1_run_rate innings2_run_rate: double; total_runs: int; is_high_scoring: boolean; "
    "margin_value: int; toss_winner_is_match_winner batting_first_won: boolean"
)


@query(
    "p4_silver_matches",
    SILVER_MATCHES + "; toss_winner toss_decision: string",
    "SELECT *, total_runs > 350 AS is_high_scoring, toss_winner_won AS toss_winner_is_match_winner FROM matches",
)
def _(t):
    return silver.silver_matches(t.raw_matches)


@query(
    "p5_keyed_dedupe",
    "match_id o_orderkey o_custkey: bigint; o_orderdate: timestamp_ntz; o_totalprice: double",
    """SELECT match_id, o_orderkey, o_custkey, o_orderdate, o_totalprice FROM (
         SELECT *, o_orderkey // 10 AS match_id,
           row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
)
def _(t):
    # Ten order records per match arrive over time; the newest one is the match's current record.
    records = t.source("orders").withColumn("match_id", F.expr("o_orderkey div 10"))
    stamped = records.withColumn("_ingestion_timestamp", F.struct("o_orderdate", "o_orderkey"))
    return silver.dedupe_latest(stamped)


@query(
    "p6_not_null_key",
    "match_id: bigint; season: int; winner: string",
    "SELECT match_id, season, winner FROM matches WHERE winner IS NOT NULL",
)
def _(t):
    # The undecided matches have no winner, so this key filter really removes rows.
    keyed = t.raw_matches.withColumns({"match": F.col("match_id"), "match_id": F.col("winner")})
    return silver.match_columns(keyed).select(F.col("match").alias("match_id"), "season", "winner")


@query(
    "p7_run_rates",
    "match_id: bigint; innings1_run_rate innings2_run_rate: double",
    "SELECT match_id, innings1_run_rate, innings2_run_rate FROM matches",
)
def _(t):
    return t.matches


@query(
    "p8_total_runs",
    "match_id: bigint; total_runs: int; is_high_scoring: boolean",
    "SELECT match_id, total_runs, total_runs > 350 AS is_high_scoring FROM matches",
)
def _(t):
    return t.matches


@query(
    "p9_margin_value",
    "match_id: bigint; margin: string; margin_value: int",
    "SELECT match_id, margin, TRY_CAST(nullif(regexp_extract(margin, '([0-9]+)', 1), '') AS INTEGER) AS margin_value "
    "FROM matches",
)
def _(t):
    return t.matches


@query(
    "p10_toss_and_batting_first",
    "match_id: bigint; toss_winner_is_match_winner batting_first_won: boolean",
    """SELECT match_id, CASE WHEN toss_winner = winner THEN TRUE ELSE FALSE END AS toss_winner_is_match_winner,
         CASE WHEN result_type = 'runs' THEN TRUE ELSE FALSE END AS batting_first_won FROM matches""",
)
def _(t):
    return t.matches


@query(
    "p11_silver_balls",
    "ball_id: string; match_id: bigint; season innings over ball runs_scored: int; batsman bowler: string; "
    "is_wicket is_dot_ball is_boundary is_four is_six: boolean",
    """SELECT *, runs_scored = 0 AS is_dot_ball, runs_scored IN (4, 6) AS is_boundary,
         runs_scored = 4 AS is_four, runs_scored = 6 AS is_six FROM balls""",
)
def _(t):
    return silver.silver_balls(t.balls)


@query(
    "p12_over_ball",
    "ball_id over_ball: string; ball_number: int",
    "SELECT ball_id, over || '.' || ball AS over_ball, over * 6 + ball + 1 AS ball_number FROM lines",
)
def _(t):
    return silver.ball_columns(t.lines)


@query(
    "p15_stg_ball_events",
    "ball_id: string; match_id: bigint; season innings over_number ball_number_in_over ball_number: int; "
    "batting_team bowling_team batsman non_striker bowler: string; runs_scored extras: int; extras_type: string; "
    "is_wicket: boolean; dismissal_type: string; is_dot_ball is_boundary is_four is_six: boolean; "
    "match_phase: string; _loaded_at: timestamp_ntz",
    """SELECT *, over AS over_number, ball AS ball_number_in_over, over * 6 + ball + 1 AS ball_number,
         runs_scored = 0 AND extras = 0 AS is_dot_ball, runs_scored IN (4, 6) AS is_boundary,
         runs_scored = 4 AS is_four, runs_scored = 6 AS is_six, phase AS match_phase, loaded_at AS _loaded_at
       FROM balls""",
)
def _(t):
    return t.stg_balls


STG_MATCHES_SQL = f"""
  SELECT * EXCLUDE (innings1_run_rate, innings2_run_rate), date AS match_date, total_runs AS total_match_runs,
    toss_winner_won AS toss_winner_won_match, opened AS _loaded_at,
    {r("10 * innings1_runs / nullif(reached1, 0)")} AS innings1_run_rate,
    {r("10 * innings2_runs / nullif(reached2, 0)")} AS innings2_run_rate
  FROM matches"""


@query(
    "p16_stg_matches",
    "match_id: bigint; season match_number: int; match_date: date; venue city team1 team2 toss_winner toss_decision "
    "first_batting second_batting: string; innings1_runs innings1_wickets: int; innings1_overs: decimal(4,1); "
    "innings2_runs innings2_wickets: int; innings2_overs: decimal(4,1); winner result_type margin player_of_match "
    "umpire1 umpire2: string; total_match_runs: int; toss_winner_won_match batting_first_won: boolean; "
    "innings1_run_rate innings2_run_rate: decimal(10,2); _loaded_at: timestamp_ntz",
    STG_MATCHES_SQL,
)
def _(t):
    return t.stg_matches


@query(
    "p17_stg_players",
    "player_id: bigint; player_name nationality: string; date_of_birth: date; "
    "batting_style bowling_style player_role: string; ipl_debut_year: int",
    "SELECT *, role AS player_role FROM players",
)
def _(t):
    return t.stg_players


@query(
    "g1_batting",
    "season: int; match_id: bigint; player_name: string; runs balls_faced fours sixes dot_balls: bigint; "
    "team: string; strike_rate boundary_percentage: double",
    f"""SELECT season, match_id, batsman AS player_name, sum(runs_scored) AS runs, count(*) AS balls_faced,
          {cnt("runs_scored = 4")} AS fours, {cnt("runs_scored = 6")} AS sixes, {DOT} AS dot_balls,
          min(batting_team) AS team, {r("100 * sum(runs_scored) / count(*)")} AS strike_rate,
          {r("100 * count(*) FILTER (WHERE runs_scored IN (4, 6)) / count(*)")} AS boundary_percentage
        FROM balls GROUP BY season, match_id, batsman""",
)
def _(t):
    return gold.batting_performance(t.balls)


@query(
    "g2_bowling",
    "season: int; match_id: bigint; player_name: string; runs_conceded balls_bowled wickets dot_balls_bowled: bigint; "
    "bowling_team: string; economy_rate overs_bowled: double",
    f"""SELECT season, match_id, bowler AS player_name, sum(runs_scored) AS runs_conceded,
          count(*) AS balls_bowled, {cnt("is_wicket")} AS wickets, {DOT} AS dot_balls_bowled,
          min(bowling_team) AS bowling_team, {r("6 * sum(runs_scored) / count(*)")} AS economy_rate,
          {r("count(*) / 6", 1)} AS overs_bowled
        FROM balls GROUP BY season, match_id, bowler""",
)
def _(t):
    return gold.bowling_performance(t.balls)


@query(
    "g3_match_summary",
    "match_id: bigint; season: int; margin: string; run_rate_diff: double; match_competitiveness: string; "
    "is_last_ball_finish: boolean",
    """SELECT match_id, season, margin, innings1_run_rate - innings2_run_rate AS run_rate_diff,
         CASE WHEN margin_value <= 10 THEN 'close' WHEN margin_value <= 30 THEN 'moderate' ELSE 'dominant' END
           AS match_competitiveness,
         result_type = 'wickets' AND reached2 >= 194 AS is_last_ball_finish
       FROM matches""",
)
def _(t):
    return gold.match_summary(t.matches)


@query(
    "g4_team_season",
    "season: int; team: string; matches_played wins: bigint; avg_runs_scored avg_run_rate batting_avg_runs "
    "batting_avg_run_rate win_percentage: double; losses: bigint",
    f"""SELECT season, team, sum(n) AS matches_played, sum(w) AS wins, sum(ar) / count(*) AS avg_runs_scored,
          sum(arr) / count(arr) AS avg_run_rate, sum(br) / sum(bn) AS batting_avg_runs,
          CAST(sum(brr) AS DOUBLE) / sum(brn) AS batting_avg_run_rate,
          {r("100 * sum(w) / sum(n)")} AS win_percentage, sum(n) - sum(w) AS losses
        FROM (
          SELECT season, team, side, count(*) AS n, {cnt("winner = team")} AS w,
            sum(slot_runs) / count(slot_runs) AS ar,
            CAST(sum(CAST(slot_rate AS DECIMAL(18,2))) AS DOUBLE) / count(slot_rate) AS arr,
            sum(batted_runs) AS br, count(batted_runs) AS bn,
            sum(CAST(batted_rate AS DECIMAL(18,2))) AS brr, count(batted_rate) AS brn
          FROM sides GROUP BY season, team, side)
        GROUP BY season, team""",
)
def _(t):
    return gold.team_statistics(t.matches)


@query(
    "g5_venue_analytics",
    "venue city: string; matches_hosted: bigint; avg_total_runs avg_first_innings avg_second_innings: double; "
    "bat_first_wins chase_wins undecided: bigint; avg_run_rate bat_first_win_pct chase_win_pct: double",
    f"""SELECT venue, city, count(*) AS matches_hosted, sum(total_runs) / count(*) AS avg_total_runs,
          sum(innings1_runs) / count(*) AS avg_first_innings, sum(innings2_runs) / count(*) AS avg_second_innings,
          {cnt("batting_first_won")} AS bat_first_wins, {cnt("NOT batting_first_won")} AS chase_wins,
          {cnt("winner IS NULL")} AS undecided,
          CAST(sum(CAST(innings1_run_rate AS DECIMAL(18,2))) AS DOUBLE) / count(innings1_run_rate) AS avg_run_rate,
          {r("100 * count(*) FILTER (WHERE batting_first_won) / count(*)")} AS bat_first_win_pct,
          {r("100 * count(*) FILTER (WHERE NOT batting_first_won) / count(*)")} AS chase_win_pct
        FROM matches GROUP BY venue, city""",
)
def _(t):
    return gold.venue_analytics(t.matches)


@query(
    "g6_toss_analysis",
    "venue toss_decision: string; total_matches toss_winner_won: bigint; toss_advantage_pct: double",
    f"""SELECT venue, toss_decision, count(*) AS total_matches, {cnt("toss_winner = winner")} AS toss_winner_won,
          {r("100 * count(*) FILTER (WHERE toss_winner = winner) / count(*)")} AS toss_advantage_pct
        FROM matches GROUP BY venue, toss_decision""",
)
def _(t):
    return gold.toss_analysis(t.matches)


@query(
    "g7_phase_analysis",
    "season: int; batting_team phase: string; total_runs total_balls wickets boundaries dot_balls: bigint; "
    "run_rate boundary_pct dot_ball_pct: double",
    f"""SELECT season, batting_team, phase, sum(runs_scored) AS total_runs, count(*) AS total_balls,
          {cnt("is_wicket")} AS wickets, {cnt("runs_scored IN (4, 6)")} AS boundaries, {DOT} AS dot_balls,
          {r("6 * sum(runs_scored) / count(*)")} AS run_rate,
          {r("100 * count(*) FILTER (WHERE runs_scored IN (4, 6)) / count(*)")} AS boundary_pct,
          {r("100 * count(*) FILTER (WHERE runs_scored = 0) / count(*)")} AS dot_ball_pct
        FROM balls GROUP BY season, batting_team, phase""",
)
def _(t):
    return gold.phase_analysis(t.balls)


STATE_SQL = f"""
  SELECT *, CASE WHEN over * 6 + ball > 0 THEN {r("6 * total_runs / (over * 6 + ball)")}
       ELSE CAST(total_runs * 10 AS DOUBLE) END AS run_rate,
    greatest(target - total_runs, 0) AS runs_needed,
    CASE WHEN innings = 2 THEN greatest(120 - over * 6 - ball, 0) END AS balls_remaining
  FROM (
    SELECT a.*, CASE WHEN innings = 2 THEN coalesce(first_total, 0) + 1 END AS target
    FROM (
      SELECT *, sum(runs_scored + extras) OVER upto AS total_runs,
        sum(CASE WHEN is_wicket THEN 1 ELSE 0 END) OVER upto AS total_wickets,
        sum(CASE WHEN extras_type IN ('wide', 'noball') THEN 0 ELSE 1 END) OVER upto AS legal_balls
      FROM lines
      WINDOW upto AS (PARTITION BY match_id, innings ORDER BY over, ball, ball_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) a
    LEFT JOIN (SELECT match_id, sum(runs_scored + extras) AS first_total FROM lines WHERE innings = 1 GROUP BY 1) f
      ON a.match_id = f.match_id)"""


@query(
    "e1_running_totals",
    "ball_id: string; match_id: bigint; innings over ball: int; total_runs total_wickets legal_balls target: bigint",
    STATE_SQL,
)
def _(t):
    return state.running_state(t.lines)


@query("e2_running_rate", "ball_id: string; total_runs: bigint; run_rate: double", STATE_SQL)
def _(t):
    return state.with_run_rate(state.running_state(t.lines))


@query(
    "e3_chase_state",
    "ball_id: string; target runs_needed: bigint; balls_remaining: int; required_rate: double",
    f"""SELECT * REPLACE (CASE WHEN target IS NOT NULL THEN runs_needed END AS runs_needed),
          CASE WHEN balls_remaining > 0 THEN {r("6 * runs_needed / balls_remaining")}
          WHEN balls_remaining = 0 THEN CAST(runs_needed * 10 AS DOUBLE) END AS required_rate
        FROM ({STATE_SQL})""",
)
def _(t):
    return state.with_chase(state.running_state(t.lines))


@query(
    "e4_match_state",
    "ball_id match_state: string; total_runs total_wickets: bigint",
    f"""SELECT *, CASE
          WHEN innings = 1 AND (total_wickets >= 10 OR done) THEN 'innings_break'
          WHEN innings = 2 AND (total_runs >= target OR total_wickets >= 10 OR done) THEN 'completed'
          ELSE 'in_progress' END AS match_state
        FROM (SELECT *, over * 6 + ball + CASE WHEN extras_type = 'none' THEN 1 ELSE 0 END >= 120 AS done
              FROM ({STATE_SQL}))""",
)
def _(t):
    return state.with_match_state(state.running_state(t.lines))


@query(
    "e5_legal_and_extras",
    "ball_id: string; is_legal: boolean; bat_runs wide_runs noball_runs: int; legal_balls: bigint",
    f"""SELECT *, extras_type NOT IN ('wide', 'noball') AS is_legal, runs_scored AS bat_runs,
          CASE WHEN extras_type = 'wide' THEN extras ELSE 0 END AS wide_runs,
          CASE WHEN extras_type = 'noball' THEN extras ELSE 0 END AS noball_runs
        FROM ({STATE_SQL})""",
)
def _(t):
    return state.with_extras_split(state.running_state(t.lines))


@query(
    "e6_match_from_events",
    "match_id: bigint; innings1_team: string; innings1_runs innings1_wickets: bigint; innings2_team: string; "
    "innings2_runs innings2_wickets: bigint; winner margin: string; total_balls total_fours total_sixes: bigint",
    f"""SELECT *, CASE WHEN innings2_runs > innings1_runs THEN second_batting ELSE first_batting END AS winner,
          CASE WHEN innings2_runs > innings1_runs THEN (10 - innings2_wickets) || ' wickets'
               ELSE (innings1_runs - innings2_runs) || ' runs' END AS margin
        FROM (
          SELECT match_id, min(batting_team) FILTER (WHERE innings = 1) AS innings1_team,
            min(batting_team) FILTER (WHERE innings = 2) AS innings2_team,
            coalesce(sum(runs_scored + extras) FILTER (WHERE innings = 1), 0) AS innings1_runs,
            coalesce(sum(runs_scored + extras) FILTER (WHERE innings = 2), 0) AS innings2_runs,
            {cnt("innings = 1 AND is_wicket")} AS innings1_wickets,
            {cnt("innings = 2 AND is_wicket")} AS innings2_wickets,
            {cnt("extras_type NOT IN ('wide', 'noball')")} AS total_balls,
            {cnt("runs_scored = 4 AND extras_type = 'none'")} AS total_fours,
            {cnt("runs_scored = 6 AND extras_type = 'none'")} AS total_sixes
          FROM balls GROUP BY match_id)
        JOIN (SELECT match_id, first_batting, second_batting FROM header) USING (match_id)""",
)
def _(t):
    return state.summarise_match(t.balls)


@query(
    "e7_phase_flags",
    "ball_id phase: string; is_powerplay is_death_overs: boolean",
    """SELECT ball_id, CASE WHEN over < 6 THEN 'powerplay' WHEN over < 16 THEN 'middle' ELSE 'death' END AS phase,
         over < 6 AS is_powerplay, over >= 16 AS is_death_overs FROM lines""",
)
def _(t):
    return state.with_phase_flags(t.lines)


def chase_sql(source: str) -> str:
    """Chase probability in SQL over a source with target, score, wickets and overs."""
    return f"""
      SELECT * EXCLUDE (required_rate, current_rate),
        {r("p", 4)} AS batting_win_probability, {r("1 - p", 4)} AS bowling_win_probability,
        {r("required_rate")} AS required_rate, {r("current_rate")} AS current_rate
      FROM (
        SELECT *, least(99e-2, greatest(1e-2, CASE WHEN runs_needed <= 0 THEN 1e0
            WHEN wickets >= 8 THEN blend * 4e-1 WHEN wickets >= 6 THEN blend * 7e-1 ELSE blend END)) AS p
        FROM (
          SELECT *, 1 / (1 + exp((rate_factor - 1) * -2)) * 6e-1
              + balls_remaining / 120 * wicket_factor * 3e-1 + wicket_factor * 1e-1 AS blend
          FROM (
            SELECT *, current_rate / greatest(1e-1, required_rate) AS rate_factor, wickets_in_hand / 10 AS wicket_factor
            FROM (
              SELECT *, runs_needed / balls_remaining * 6 AS required_rate,
                score / greatest(1e0, overs * 6) * 6 AS current_rate
              FROM (
                SELECT *, target - score AS runs_needed, 10 - wickets AS wickets_in_hand,
                  greatest(1, CAST(trunc((20 - overs) * 6) AS INTEGER)) AS balls_remaining
                FROM ({source})
                WHERE target > 0 AND score >= 0 AND wickets BETWEEN 0 AND 10 AND overs BETWEEN 0 AND 20)))))"""


CHASE_COLUMNS = (
    "batting_win_probability bowling_win_probability required_rate current_rate: double; "
    "runs_needed: bigint; balls_remaining wickets_in_hand: int"
)


@query(
    "e8_ball_win_probability",
    "ball_id: string; match_id: bigint; over ball: int; " + CHASE_COLUMNS,
    chase_sql(
        f"""SELECT ball_id, match_id, innings, over, ball, target, total_runs AS score, total_wickets AS wickets,
              over + ball / 6 AS overs FROM ({STATE_SQL}) WHERE innings = 2"""
    ),
)
def _(t):
    return state.win_probability_per_ball(t.lines)


@query(
    "e9_batting_first",
    "match_id: bigint; batting_first: string",
    """SELECT match_id, CASE WHEN toss_decision = 'bat' THEN toss_winner
         ELSE replace(team1 || team2, toss_winner, '') END AS batting_first FROM header""",
)
def _(t):
    return t.raw_matches.withColumn("batting_first", m.batting_first())


def _chases(t: Tables):
    return t.matches.select(
        "match_id",
        (F.col("innings1_runs") + 1).alias("target"),
        F.col("innings2_runs").alias("score"),
        F.col("innings2_wickets").alias("wickets"),
        F.col("innings2_overs").alias("overs"),
    )


@query(
    "m1_rejected_states",
    "match_id: bigint; target score wickets: int; overs: double",
    """SELECT * FROM (SELECT match_id, innings1_runs + 1 AS target, innings2_runs AS score, innings2_wickets AS wickets,
           innings2_overs AS overs FROM matches)
       WHERE NOT coalesce(target > 0 AND score >= 0 AND wickets BETWEEN 0 AND 10 AND overs BETWEEN 0 AND 20, false)""",
)
def _(t):
    return scoring.quarantine(_chases(t))[1]


@query(
    "m1_chase_probability",
    "match_id: bigint; " + CHASE_COLUMNS,
    chase_sql(
        """SELECT match_id, innings1_runs + 1 AS target, innings2_runs AS score, innings2_wickets AS wickets,
             innings2_overs AS overs FROM matches"""
    ),
)
def _(t):
    return scoring.with_chase_probability(scoring.quarantine(_chases(t))[0])


@query(
    "m2_first_innings_projection",
    "match_id: bigint; batting_win_probability bowling_win_probability: double; projected_total: bigint",
    f"""SELECT match_id, {r("p", 4)} AS batting_win_probability, {r("1 - p", 4)} AS bowling_win_probability,
          round_even(projected, 0) AS projected_total
        FROM (
          SELECT *, least(95e-2, greatest(5e-2, 5e-1 + (projected - 165) * 8e-3 - wickets * 3e-2)) AS p
          FROM (
            SELECT match_id, innings1_wickets AS wickets, CASE WHEN innings1_overs <= 0 THEN 165e0 ELSE
                innings1_runs + innings1_runs / innings1_overs * (20 - innings1_overs)
                * CASE WHEN innings1_overs < 6 THEN 13e-1 WHEN innings1_overs < 15 THEN 115e-2 ELSE 105e-2 END
                * greatest(5e-1, 1 - innings1_wickets * 8e-2) END AS projected
            FROM matches))""",
)
def _(t):
    states = t.matches.select(
        "match_id",
        F.col("innings1_runs").alias("score"),
        F.col("innings1_wickets").alias("wickets"),
        F.col("innings1_overs").alias("overs"),
    )
    return scoring.with_first_innings_probability(states)


FULL_LINE_SQL = f"""
  SELECT match_id, player, coalesce(runs, 0) AS runs, coalesce(faced, 0) AS faced, coalesce(fours, 0) AS fours,
    coalesce(sixes, 0) AS sixes, coalesce(wickets, 0) AS wickets, coalesce(conceded, 0) AS conceded,
    coalesce(overs, 0) AS overs, coalesce(caught, 0) AS caught, coalesce(run_outs, 0) AS run_outs
  FROM (SELECT match_id, batsman AS player, sum(runs_scored) AS runs, count(*) AS faced,
          {cnt("runs_scored = 4")} AS fours, {cnt("runs_scored = 6")} AS sixes FROM balls GROUP BY 1, 2) a
  FULL JOIN (SELECT match_id, bowler AS player, {cnt("is_wicket")} AS wickets, sum(runs_scored) AS conceded,
          {r("count(*) / 6", 1)} AS overs, {cnt("is_wicket AND dismissal_type = 'caught'")} AS caught,
          {cnt("is_wicket AND dismissal_type = 'run out'")} AS run_outs FROM balls GROUP BY 1, 2) b
  USING (match_id, player)"""


@query(
    "m3_full_fantasy",
    "match_id: bigint; player: string; batting_points bowling_points fielding_points total_fantasy_points: double",
    f"""SELECT *, batting_points + bowling_points + fielding_points AS total_fantasy_points FROM (
          SELECT match_id, player,
            runs + fours + 2 * sixes + CASE WHEN runs >= 50 THEN 25 ELSE 0 END + CASE WHEN runs >= 100 THEN 50 ELSE 0 END
              - CASE WHEN runs = 0 AND faced > 0 THEN 2 ELSE 0 END
              + CASE WHEN faced = 0 THEN 0 WHEN 100 * runs >= 170 * faced THEN 6 WHEN 100 * runs >= 150 * faced THEN 4
                  WHEN 100 * runs >= 130 * faced THEN 2 WHEN faced < 10 THEN 0
                  WHEN 100 * runs < 60 * faced THEN -6 WHEN 100 * runs < 70 * faced THEN -4 ELSE 0 END
              AS batting_points,
            25 * wickets + CASE WHEN wickets >= 3 THEN 25 ELSE 0 END + CASE WHEN wickets >= 5 THEN 50 ELSE 0 END
              + CASE WHEN overs < 2 THEN 0 WHEN conceded / overs <= 5 THEN 6 WHEN conceded / overs <= 6 THEN 4
                  WHEN conceded / overs <= 7 THEN 2 WHEN conceded / overs >= 12 THEN -6
                  WHEN conceded / overs >= 11 THEN -4 ELSE 0 END AS bowling_points,
            8 * caught + 12 * run_outs AS fielding_points
          FROM ({FULL_LINE_SQL}))""",
)
def _(t):
    # Deliveries name no fielder; the bowler stands in for catches and run-outs here.
    line = lines.player_line(t.balls, ["match_id", "player"])
    fielding = {"catches": F.col("caught_off"), "run_outs": F.col("run_out_off")}
    return line.withColumns(fielding).withColumns(scoring.fantasy_points())


@query(
    "w9_without_run_outs",
    "player: string; dismissals wickets run_out_off: bigint",
    f"""SELECT coalesce(a.player, b.player) AS player, coalesce(dismissals, 0) AS dismissals, coalesce(wickets, 0) AS wickets,
          coalesce(run_out_off, 0) AS run_out_off
        FROM (SELECT batsman AS player, {cnt("is_wicket AND dismissal_type <> 'run out'")} AS dismissals
              FROM balls GROUP BY 1) a
        FULL JOIN (SELECT bowler AS player, {cnt("is_wicket AND dismissal_type <> 'run out'")} AS wickets,
              {cnt("is_wicket AND dismissal_type = 'run out'")} AS run_out_off FROM balls GROUP BY 1) b
        ON a.player = b.player""",
)
def _(t):
    line = lines.player_line(t.balls, ["player"], exclude_run_outs=True)
    return line.select("player", "dismissals", "wickets", "run_out_off")


@query(
    "m4_simple_fantasy",
    "match_id: bigint; player: string; fantasy_points: double",
    f"""SELECT match_id, player, runs + fours + 2 * sixes + 25 * wickets
          + CASE WHEN runs >= 50 THEN 25 ELSE 0 END + CASE WHEN runs >= 100 THEN 50 ELSE 0 END
          + CASE WHEN wickets >= 3 THEN 25 ELSE 0 END AS fantasy_points
        FROM ({FULL_LINE_SQL})""",
)
def _(t):
    line = lines.player_line(t.balls, ["match_id", "player"])
    return line.select("match_id", "player", scoring.simple_fantasy_points().alias("fantasy_points"))


@query(
    "m5_pressure_index",
    "ball_id: string; pressure_index required_rate wicket_pressure rate_pressure: double; assessment: string",
    f"""SELECT ball_id, {r("idx", 1)} AS pressure_index, {r("rr")} AS required_rate,
          {r("wp * 100", 1)} AS wicket_pressure, {r("rp * 100", 1)} AS rate_pressure,
          CASE WHEN idx > 80 THEN 'extreme' WHEN idx > 60 THEN 'high' WHEN idx > 40 THEN 'moderate'
            WHEN idx IS NOT NULL THEN 'low' END
            AS assessment
        FROM (
          SELECT *, (rp * 4e-1 + wp * 35e-2 + (1 - balls_remaining / 120) * 25e-2) * 100 AS idx
          FROM (
            SELECT *, (10 - total_wickets) AS wih, (10 - (10 - total_wickets)) / 10 AS wp, least(rr / 12, 1e0) AS rp
            FROM (SELECT *, CASE WHEN balls_remaining > 0 THEN runs_needed / balls_remaining * 6 ELSE 999e0 END AS rr
                  FROM ({STATE_SQL}))))""",
)
def _(t):
    chase = state.with_chase(state.running_state(t.lines))
    return scoring.with_pressure(chase.withColumn("wickets_in_hand", F.lit(10) - F.col("total_wickets")))
