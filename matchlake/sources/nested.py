"""Nested match documents: one JSON file per match, flattened to header and delivery rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchlake.functions.metrics import is_true
from matchlake.schemas import MATCH_DOCUMENT
from matchlake.sources.io import CORRUPT

# Fixed value of the published output.
SOURCE = "cricsheet"


def read_documents(spark: SparkSession, directory: str, limit: int | None = None) -> DataFrame:
    """Match documents of a directory; unreadable files and files without `info` are left out.

    `limit` takes the first files by name, good or bad, as a loader working through the folder would.
    """
    schema = StructType([*MATCH_DOCUMENT.fields, StructField(CORRUPT, StringType())])
    files = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .json(directory)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    if limit:
        files = files.orderBy("source_file").limit(limit)
    return files.where(F.col(CORRUPT).isNull() & F.col("info").isNotNull()).drop(CORRUPT)


def _text(c: str, default: str = "") -> Column:
    return F.coalesce(F.col(c), F.lit(default))


def match_headers(documents: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    return documents.select(
        F.lit(SOURCE).alias("source"),
        "source_file",
        F.coalesce("info.teams", empty).alias("teams"),
        _text("info.gender", "male").alias("gender"),
        _text("info.match_type", "T20").alias("match_type"),
        _text("info.season").alias("season"),
        F.coalesce(F.get("info.dates", 0), F.lit("")).alias("date"),
        _text("info.venue").alias("venue"),
        _text("info.city").alias("city"),
        F.col("info.toss").alias("toss"),
        F.col("info.outcome").alias("outcome"),
        F.coalesce("info.player_of_match", empty).alias("player_of_match"),
        F.coalesce("info.umpires", empty).alias("umpires"),
    )


def deliveries(documents: DataFrame) -> DataFrame:
    """One row per delivery with its match header; innings counted from 1 by position."""
    # Header values are taken out before exploding, so the document is not copied into every row.
    head = documents.select(
        "source_file",
        _text("info.venue").alias("venue"),
        _text("info.city").alias("city"),
        F.coalesce(F.get("info.dates", 0), F.lit("")).alias("date"),
        _text("info.season").alias("season"),
        F.coalesce(F.get("info.teams", 0), F.lit("")).alias("team1"),
        F.coalesce(F.get("info.teams", 1), F.lit("")).alias("team2"),
        "innings",
    )
    header = head.columns[:-1]
    by_innings = head.select(*header, F.posexplode("innings").alias("_pos", "_named"))
    by_detail = by_innings.select(
        *header, (F.col("_pos") + 1).alias("innings"), F.explode(F.map_values("_named")).alias("_detail")
    )
    by_delivery = by_detail.select(*header, "innings", F.explode("_detail.deliveries").alias("_delivery"))
    flat = by_delivery.select(*header, "innings", F.explode("_delivery").alias("over_ball", "d"))
    extra = F.get(F.map_entries("d.extras"), 0)
    wicket = F.get("d.wickets", 0)
    is_wicket = is_true(F.size("d.wickets") > 0)
    runs = lambda c: F.coalesce(F.col(f"d.runs.{c}"), F.lit(0))
    return flat.select(
        *header,
        "innings",
        "over_ball",
        _text("d.batsman").alias("batsman"),
        _text("d.bowler").alias("bowler"),
        _text("d.non_striker").alias("non_striker"),
        runs("batsman").alias("runs_batsman"),
        runs("extras").alias("runs_extras"),
        runs("total").alias("runs_total"),
        extra["key"].alias("extras_type"),
        extra["value"].alias("extras_value"),
        is_wicket.alias("is_wicket"),
        F.when(is_wicket, F.coalesce(wicket["kind"], F.lit(""))).alias("dismissal_type"),
        F.when(is_wicket, F.coalesce(wicket["player_out"], F.lit(""))).alias("dismissed_player"),
    )

