"""Query registry: each entry pairs a DataFrame plan with independent SQL over the same tables.

Both sides are cast to the entry's declared columns, so types agree whatever each engine infers.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import silver, staging
from matchlake.sources import adapter


class Tables:
    """The engine's tables over one test-data folder; each is a lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def source(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    @cached_property
    def lines(self) -> DataFrame:
        return adapter.ball_lines(self.spark, self.sf_dir)

    @cached_property
    def balls(self) -> DataFrame:
        return adapter.balls(self.spark, self.sf_dir)

    @cached_property
    def raw_matches(self) -> DataFrame:
        return adapter.matches(self.spark, self.sf_dir)

    @cached_property
    def matches(self) -> DataFrame:
        return silver.match_columns(self.raw_matches)

    @cached_property
    def players(self) -> DataFrame:
        return adapter.players(self.spark, self.sf_dir)

    @cached_property
    def live(self) -> DataFrame:
        return adapter.live_events(self.spark, self.sf_dir)

    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw_matches)

    @cached_property
    def stg_balls(self) -> DataFrame:
        return staging.stg_ball_events(self.balls)

    @cached_property
    def stg_players(self) -> DataFrame:
        return staging.stg_players(self.players)


@dataclass(frozen=True)
class Query:
    columns: tuple[tuple[str, str], ...]
    plan: Callable[[Tables], DataFrame]
    sql: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.plan(Tables(spark, sf_dir))
        return out.select(*[F.col(n).cast(t).alias(n) for n, t in self.columns])

    def oracle(self) -> str:
        types = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
        cast = ", ".join(f'CAST("{n}" AS {types.get(t, t.upper())}) AS "{n}"' for n, t in self.columns)
        return f"WITH {BASE_SQL}, answer AS (\n{self.sql.strip()}\n)\nSELECT {cast} FROM answer"


REGISTRY: dict[str, Query] = {}


def _columns(ddl: str) -> tuple[tuple[str, str], ...]:
    """'a b: int; c: string' as pairs."""
    groups = [group.split(":") for group in ddl.split(";")]
    return tuple((name, kind.strip()) for names, kind in groups for name in names.split())


def query(name: str, columns: str, sql: str):
    def register(plan: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(_columns(columns), plan, sql)
        return plan

    return register


def r(x: str, dp: int = 2) -> str:
    """SQL rounding half away from zero on the shortest decimal form of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,22)), {dp}) AS DOUBLE)"


def cnt(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


BASE_SQL = f"""
header AS (
  SELECT *, CASE WHEN first_batting = team1 THEN team2 ELSE team1 END AS second_batting
  FROM (
    SELECT *, CASE WHEN toss_decision = 'bat' THEN toss_winner
                   WHEN toss_winner = team1 THEN team2 ELSE team1 END AS first_batting
    FROM (
      SELECT match_id, opened, CAST(opened AS DATE) AS date, CAST(year(opened) AS INTEGER) AS season,
        CAST(match_id % 74 + 1 AS INTEGER) AS match_number,
        'V' || (draw % 12) AS venue, 'C' || (draw % 24 % 9) AS city,
        'T' || home AS team1, 'T' || away AS team2,
        CASE WHEN finished % 2 = 0 THEN 'T' || home ELSE 'T' || away END AS toss_winner,
        CASE WHEN urgent % 2 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
        'T' || home || '-' || (draw % 11) AS player_of_match,
        'U' || (draw % 17) AS umpire1, 'U' || (draw % 19 + 17) AS umpire2
      FROM (
        SELECT *, (home + 1 + match_id % 9) % 10 AS away
        FROM (
          SELECT o_orderkey // 10 AS match_id, arg_min(o_orderdate, o_orderkey) AS opened,
            CAST(sum(o_custkey) AS BIGINT) AS draw,
            (CAST(sum(o_custkey) AS BIGINT) // 12) % 10 AS home,
            count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
            count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent
          FROM orders GROUP BY 1)))
  )
),
lines AS (
  SELECT *,
    CASE WHEN extra THEN 1 ELSE 0 END AS extras,
    CASE WHEN extra AND partkey % 2 = 0 THEN 'wide' WHEN extra THEN 'noball' ELSE 'none' END AS extras_type,
    CASE WHEN is_wicket THEN ['bowled', 'caught', 'lbw', 'run out', 'stumped'][partkey % 5 + 1]
         ELSE 'none' END AS dismissal_type
  FROM (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
        || CAST(round(l_extendedprice * 100) AS BIGINT) AS ball_id,
      l_orderkey // 10 AS match_id,
      CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS innings,
      CAST((l_orderkey * 2 + CAST(l_quantity AS INTEGER)) % 20 AS INTEGER) AS over,
      CAST((l_linenumber - 1) % 6 AS INTEGER) AS ball,
      [0, 1, 2, 0, 4, 1, 6, 3][CAST(l_quantity AS INTEGER) % 8 + 1] AS runs_scored,
      l_returnflag = 'R' AND CAST(l_quantity AS INTEGER) % 8 IN (0, 3) AS is_wicket,
      l_returnflag = 'A' AND l_linenumber % 3 = 0 AS extra,
      l_partkey AS partkey, l_suppkey AS suppkey
    FROM lineitem)
),
balls AS (
  SELECT l.*, season, opened AS loaded_at,
    CASE WHEN innings = 1 THEN first_batting ELSE second_batting END AS batting_team,
    CASE WHEN innings = 1 THEN second_batting ELSE first_batting END AS bowling_team,
    (CASE WHEN innings = 1 THEN first_batting ELSE second_batting END) || '-' || (partkey % 11) AS batsman,
    (CASE WHEN innings = 1 THEN first_batting ELSE second_batting END) || '-' || ((partkey + 1) % 11)
      AS non_striker,
    (CASE WHEN innings = 1 THEN second_batting ELSE first_batting END) || '-' || (suppkey % 11) AS bowler,
    CASE WHEN over < 6 THEN 'powerplay' WHEN over < 16 THEN 'middle' ELSE 'death' END AS phase
  FROM lines l JOIN header h ON l.match_id = h.match_id
),
results AS (
  SELECT match_id,
    coalesce(sum(runs_scored + extras) FILTER (WHERE innings = 1), 0) AS i1,
    coalesce(sum(runs_scored + extras) FILTER (WHERE innings = 2), 0) AS i2,
    count(*) FILTER (WHERE innings = 1 AND is_wicket) AS w1,
    count(*) FILTER (WHERE innings = 2 AND is_wicket) AS w2,
    coalesce(max(over * 10 + ball + 1) FILTER (WHERE innings = 1), 0) AS reached1,
    coalesce(max(over * 10 + ball + 1) FILTER (WHERE innings = 2), 0) AS reached2
  FROM lines GROUP BY 1
),
raw_matches AS (
  SELECT h.*, CAST(coalesce(i1, 0) AS INTEGER) AS innings1_runs, CAST(coalesce(w1, 0) AS INTEGER) AS innings1_wickets,
    coalesce(reached1, 0) / 10 AS innings1_overs,
    CAST(coalesce(i2, 0) AS INTEGER) AS innings2_runs, CAST(coalesce(w2, 0) AS INTEGER) AS innings2_wickets,
    coalesce(reached2, 0) / 10 AS innings2_overs,
    coalesce(reached1, 0) AS reached1, coalesce(reached2, 0) AS reached2,
    CASE WHEN coalesce(i1, 0) > coalesce(i2, 0) THEN first_batting
         WHEN coalesce(i1, 0) < coalesce(i2, 0) THEN second_batting END AS winner,
    CASE WHEN coalesce(i1, 0) > coalesce(i2, 0) THEN 'runs'
         WHEN coalesce(i1, 0) < coalesce(i2, 0) THEN 'wickets' ELSE 'tie' END AS result_type,
    CASE WHEN coalesce(i1, 0) > coalesce(i2, 0) THEN (i1 - i2) || ' runs'
         WHEN coalesce(i1, 0) < coalesce(i2, 0) THEN greatest(10 - w2, 0) || ' wickets' ELSE 'tie' END AS margin
  FROM header h LEFT JOIN results s ON h.match_id = s.match_id
),
matches AS (
  SELECT *,
    {r("innings1_runs / nullif(innings1_overs, 0)")} AS innings1_run_rate,
    {r("innings2_runs / nullif(innings2_overs, 0)")} AS innings2_run_rate,
    innings1_runs + innings2_runs AS total_runs,
    CASE WHEN margin <> 'tie' THEN CAST(split_part(margin, ' ', 1) AS INTEGER) END AS margin_value,
    coalesce(toss_winner = winner, FALSE) AS toss_winner_won,
    result_type = 'runs' AS batting_first_won
  FROM raw_matches
),
sides AS (
  SELECT match_id, season, 1 AS side, team1 AS team, team2 AS opponent, winner,
    innings1_runs AS slot_runs, innings1_run_rate AS slot_rate,
    CASE WHEN first_batting = team1 THEN innings1_runs ELSE innings2_runs END AS batted_runs,
    CASE WHEN first_batting = team1 THEN innings1_run_rate ELSE innings2_run_rate END AS batted_rate
  FROM matches
  UNION ALL
  SELECT match_id, season, 2, team2, team1, winner, innings2_runs, innings2_run_rate,
    CASE WHEN first_batting = team2 THEN innings1_runs ELSE innings2_runs END,
    CASE WHEN first_batting = team2 THEN innings1_run_rate ELSE innings2_run_rate END
  FROM matches
),
players AS (
  SELECT c_custkey AS player_id, 'T' || (c_custkey % 10) || '-' || (c_custkey // 10) AS player_name,
    'N' || c_nationkey AS nationality, DATE '1980-01-01' + CAST(c_custkey % 7000 AS INTEGER) AS date_of_birth,
    ['Right', 'Left'][c_custkey // 10 % 2 + 1] AS batting_style, c_mktsegment AS bowling_style,
    ['Batsman', 'Bowler', 'All-rounder', 'Wicketkeeper'][c_custkey // 10 % 4 + 1] AS role,
    CAST(2008 + c_custkey % 16 AS INTEGER) AS ipl_debut_year
  FROM customer
),
live AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id AS match_id, CAST(event_id % 2 + 1 AS INTEGER) AS innings,
    'T' || (user_id % 10) AS batting_team, 'T' || ((user_id + 1) % 10) AS bowling_team,
    'P' || (event_id % 11) AS batsman, 'Q' || (event_id % 7) AS bowler,
    CAST(event_id // 7 % 20 AS INTEGER) AS over, CAST(event_id % 6 AS INTEGER) AS ball,
    CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 4 WHEN 'purchase' THEN 6 ELSE 0 END AS runs_scored,
    event_type = 'error' AS is_wicket, CASE WHEN event_type = 'error' THEN 'bowled' END AS dismissal_type,
    CAST(event_id % 200 AS INTEGER) AS total_runs, CAST(event_id % 10 AS INTEGER) AS total_wickets,
    event_id % 97 / 8 AS run_rate, ts, props
  FROM events
)
"""
