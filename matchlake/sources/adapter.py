"""Maps the star-schema test tables onto matches, deliveries, players and live events.

Every row of orders, lineitem, customer and events is used. Ten consecutive orders make one match
(their lines are its deliveries), customers are the player register, events are the live feed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators.state import match_results


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tag(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match: who met, where, when, and the toss."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("o_orderkey div 10").alias("match_id"))
        .agg(
            F.min_by("o_orderdate", "o_orderkey").alias("opened"),
            F.sum("o_custkey").alias("draw"),
            F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
            F.count_if(urgent).alias("urgent"),
        )
    )
    home = F.expr("(draw div 12) % 10")
    away = (home + 1 + F.col("match_id") % 9) % 10
    base = grouped.select(
        "match_id",
        F.year("opened").alias("season"),
        (F.col("match_id") % 74 + 1).cast("int").alias("match_number"),
        F.to_date("opened").cast("string").alias("date"),
        _tag("V", F.col("draw") % 12).alias("venue"),
        _tag("C", F.col("draw") % 24 % 9).alias("city"),
        _tag("T", home).alias("team1"),
        _tag("T", away).alias("team2"),
        F.when(F.col("finished") % 2 == 0, _tag("T", home)).otherwise(_tag("T", away)).alias("toss_winner"),
        F.when(F.col("urgent") % 2 == 0, "bat").otherwise("field").alias("toss_decision"),
        F.concat(_tag("T", home), _tag("-", F.col("draw") % 11)).alias("player_of_match"),
        _tag("U", F.col("draw") % 17).alias("umpire1"),
        _tag("U", F.col("draw") % 19 + 17).alias("umpire2"),
        F.col("opened").alias("_ingestion_timestamp"),
    )
    first = m.batting_first()
    return base.withColumns(
        {
            "first_batting": first,
            "second_batting": F.when(first == F.col("team1"), F.col("team2")).otherwise(F.col("team1")),
        }
    )


def ball_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries without header columns: what a scorer records, with squad slots for players."""
    qty = F.col("l_quantity").cast("int")
    code = qty % 8
    wicket = (F.col("l_returnflag") == "R") & code.isin(0, 3)
    extra = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") % 3 == 0)
    kinds = F.array(*[F.lit(k) for k in ("bowled", "caught", "lbw", "run out", "stumped")])
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        ).alias("ball_id"),
        F.expr("l_orderkey div 10").alias("match_id"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("innings"),
        ((F.col("l_orderkey") * 2 + qty) % 20).cast("int").alias("over"),
        ((F.col("l_linenumber") - 1) % 6).cast("int").alias("ball"),
        F.when(code.isin(1, 5), 1)
        .when(code.isin(2, 4, 6), code)
        .when(code == 7, 3)
        .otherwise(0)
        .alias("runs_scored"),
        F.when(extra, 1).otherwise(0).alias("extras"),
        F.when(extra & (F.col("l_partkey") % 2 == 0), "wide").when(extra, "noball").otherwise("none").alias("extras_type"),
        wicket.alias("is_wicket"),
        F.when(wicket, F.get(kinds, (F.col("l_partkey") % 5).cast("int"))).otherwise("none").alias("dismissal_type"),
        (F.col("l_partkey") % 11).alias("striker_slot"),
        ((F.col("l_partkey") + 1) % 11).alias("non_striker_slot"),
        (F.col("l_suppkey") % 11).alias("bowler_slot"),
    )


def balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with teams, players and season, the shape every operator takes."""
    header = headers(spark, sf_dir).select(
        "match_id",
        "season",
        "first_batting",
        "second_batting",
        "_ingestion_timestamp",
    )
    first = F.col("innings") == 1
    joined = ball_lines(spark, sf_dir).join(header, "match_id").withColumns(
        {
            "batting_team": F.when(first, F.col("first_batting")).otherwise(F.col("second_batting")),
            "bowling_team": F.when(first, F.col("second_batting")).otherwise(F.col("first_batting")),
        }
    )
    player = lambda team, number: F.concat_ws("-", team, number)
    return joined.select(
        "ball_id",
        "match_id",
        "season",
        "innings",
        "over",
        "ball",
        "batting_team",
        "bowling_team",
        player("batting_team", "striker_slot").alias("batsman"),
        player("batting_team", "non_striker_slot").alias("non_striker"),
        player("bowling_team", "bowler_slot").alias("bowler"),
        "runs_scored",
        "extras",
        "extras_type",
        "is_wicket",
        "dismissal_type",
        m.phase().alias("phase"),
        "_ingestion_timestamp",
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match records with results. Scores are summed per match before meeting the header."""
    header = headers(spark, sf_dir)
    joined = header.join(match_results(ball_lines(spark, sf_dir)), "match_id", "left")
    lead = F.col("runs_1") - F.col("runs_2")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    filled = joined.withColumns(
        {c: zero(c) for c in ("runs_1", "runs_2", "wickets_1", "wickets_2")}
        | {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("overs_1", "overs_2")}
    )
    return filled.select(
        *[c for c in header.columns],
        F.col("runs_1").alias("innings1_runs"),
        F.col("wickets_1").alias("innings1_wickets"),
        F.col("overs_1").alias("innings1_overs"),
        F.col("runs_2").alias("innings2_runs"),
        F.col("wickets_2").alias("innings2_wickets"),
        F.col("overs_2").alias("innings2_overs"),
        F.when(lead > 0, F.col("first_batting")).when(lead < 0, F.col("second_batting")).alias("winner"),
        F.when(lead > 0, "runs").when(lead < 0, "wickets").otherwise("tie").alias("result_type"),
        F.when(lead > 0, F.concat(lead.cast("string"), F.lit(" runs")))
        .when(
            lead < 0,
            F.concat(F.greatest(F.lit(10) - F.col("wickets_2"), F.lit(0)).cast("string"), F.lit(" wickets")),
        )
        .otherwise("tie")
        .alias("margin"),
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is a registered player; the first eleven of each side take the field."""
    squad = F.expr("c_custkey div 10")
    pick = lambda *v: F.get(F.array(*[F.lit(x) for x in v]), (squad % len(v)).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"),
        F.concat(_tag("T", F.col("c_custkey") % 10), _tag("-", squad)).alias("player_name"),
        _tag("N", F.col("c_nationkey")).alias("nationality"),
        F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 7000).cast("int"))
        .cast("string")
        .alias("date_of_birth"),
        pick("Right", "Left").alias("batting_style"),
        F.col("c_mktsegment").alias("bowling_style"),
        pick("Batsman", "Bowler", "All-rounder", "Wicketkeeper").alias("role"),
        (F.lit(2008) + F.col("c_custkey") % 16).cast("int").alias("ipl_debut_year"),
    )


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_live(table(spark, sf_dir, "events"))


def shape_live(events: DataFrame) -> DataFrame:
    """Event log, batch or stream, as live deliveries. `ts` becomes a zoned timestamp for watermarks."""
    runs = (
        F.when(F.col("event_type") == "click", 1)
        .when(F.col("event_type") == "signup", 4)
        .when(F.col("event_type") == "purchase", 6)
        .otherwise(0)
    )
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").alias("match_id"),
        (F.col("event_id") % 2 + 1).cast("int").alias("innings"),
        _tag("T", F.col("user_id") % 10).alias("batting_team"),
        _tag("T", (F.col("user_id") + 1) % 10).alias("bowling_team"),
        _tag("P", F.col("event_id") % 11).alias("batsman"),
        _tag("Q", F.col("event_id") % 7).alias("bowler"),
        F.expr("cast((event_id div 7) % 20 as int)").alias("over"),
        (F.col("event_id") % 6).cast("int").alias("ball"),
        runs.alias("runs_scored"),
        (F.col("event_type") == "error").alias("is_wicket"),
        F.when(F.col("event_type") == "error", "bowled").alias("dismissal_type"),
        (F.col("event_id") % 200).cast("int").alias("total_runs"),
        (F.col("event_id") % 10).cast("int").alias("total_wickets"),
        (F.col("event_id") % 97 / 8.0).alias("run_rate"),
        F.col("ts").cast("timestamp").alias("event_time"),
        "props",
    )
