"""Bronze to silver: typed, de-duplicated, derived columns. One projection per table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators.ranking import latest_per_key
from matchlake.schemas import METADATA_COLUMNS

HIGH_SCORING_ABOVE = 350


def dedupe_latest(df: DataFrame, key: str = "match_id", order_col: str = "_ingestion_timestamp") -> DataFrame:
    """Keeps the most recently ingested row per key; equal times fall back to a hash of the row, so
    the survivor never depends on partitioning."""
    newest = [F.col(order_col).desc_nulls_last()] if order_col in df.columns else []
    return latest_per_key(df, [key], [*newest, F.xxhash64(*df.columns)])


def match_columns(raw: DataFrame) -> DataFrame:
    """Casts and derived match columns; rows without match_id are dropped."""
    cast = lambda c, t: F.col(c).try_cast(t)
    typed = raw.where(F.col("match_id").isNotNull()).withColumns(
        {
            "date": F.try_to_date(F.col("date").cast("string"), "yyyy-MM-dd"),
            "season": cast("season", "int"),
            **{f"innings{n}_{c}": cast(f"innings{n}_{c}", "int") for n in (1, 2) for c in ("runs", "wickets")},
            **{f"innings{n}_overs": cast(f"innings{n}_overs", "double") for n in (1, 2)},
        }
    )
    total = F.col("innings1_runs") + F.col("innings2_runs")
    return typed.withColumns(
        {
            "innings1_run_rate": m.ratio(F.col("innings1_runs"), F.col("innings1_overs")),
            "innings2_run_rate": m.ratio(F.col("innings2_runs"), F.col("innings2_overs")),
            "total_runs": total,
            "is_high_scoring": m.is_true(total > HIGH_SCORING_ABOVE),
            "margin_value": F.regexp_extract("margin", r"(\d+)", 1).try_cast("int"),
            "toss_winner_is_match_winner": m.same(F.col("toss_winner"), F.col("winner")),
            "batting_first_won": m.is_true(F.col("result_type") == "runs"),
        }
    )


def silver_matches(raw: DataFrame) -> DataFrame:
    return _processed(match_columns(dedupe_latest(raw)))


def ball_columns(raw: DataFrame) -> DataFrame:
    ints = ("runs_scored", "innings", "over", "ball")
    typed = raw.where(F.col("match_id").isNotNull()).withColumns({c: F.col(c).try_cast("int") for c in ints})
    return typed.withColumns(
        {
            "is_dot_ball": m.is_dot("bat"),
            "is_boundary": m.is_boundary(),
            "is_four": m.is_four(),
            "is_six": m.is_six(),
            "over_ball": F.concat(F.col("over").cast("string"), F.lit("."), F.col("ball").cast("string")),
            "ball_number": m.ball_number(),
        }
    )


def silver_balls(raw: DataFrame, streamed: DataFrame | None = None) -> DataFrame:
    """Deliveries, the newest load of each; those of the stream are added where the batch has none."""
    if "_ingestion_timestamp" in raw.columns:
        raw = newest_balls(raw)
    if streamed is not None:
        raw = raw.unionByName(only_streamed(streamed, raw), allowMissingColumns=True)
    return _processed(ball_columns(raw))


def only_streamed(streamed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Streamed deliveries that no load has."""
    return streamed.join(loaded.select("ball_id").distinct(), "ball_id", "left_anti")


def newest_balls(raw: DataFrame) -> DataFrame:
    """Deliveries without the older loads of a ball that was loaded again with other values. Rows of one load stay
    as they are, also those without an id."""
    last = raw.where(F.col("ball_id").isNotNull()).groupBy("ball_id").agg(F.max("_ingestion_timestamp").alias("_last"))
    older = raw.join(last, "ball_id", "left").where(F.col("_last").isNull() | (F.col("_ingestion_timestamp") == F.col("_last")))
    return older.select(*raw.columns)


def _processed(df: DataFrame) -> DataFrame:
    return df.drop(*METADATA_COLUMNS).withColumn("_processed_timestamp", F.current_timestamp())
