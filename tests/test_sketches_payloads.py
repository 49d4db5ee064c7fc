"""Sketches against exact results and their stated errors; variant payloads and schema drift."""

from pyspark.sql import functions as F

from matchlake.operators import sketches
from matchlake.schemas import INT, STRING, _struct
from matchlake.sources import payloads


def test_distinct_merges_without_rescan(spark):
    df = spark.range(300_000).select((F.col("id") % 5).alias("season"), F.pmod(F.hash("id"), F.lit(90_000)).alias("player"), (F.col("id") % 77).alias("team"))
    df = df.withColumn("team", F.when(F.col("team") > 0, F.col("team")))
    parts = sketches.distinct_sketches(df, ["season"], ["player", "team"])
    got = sketches.distinct_counts(sketches.merge_distinct(parts, [], ["player", "team"]), ["player", "team"]).first()
    exact = df.agg(F.countDistinct("player").alias("player"), F.countDistinct("team").alias("team")).first()
    assert got.team == exact.team == 76
    assert abs(got.player / exact.player - 1) < 4 * 2**-8
    seasons = {r.season: r for r in sketches.distinct_counts(parts, ["player", "team"]).collect()}
    want = {r.season: r.n for r in df.groupBy("season").agg(F.countDistinct("player").alias("n")).collect()}
    assert {k: r.player for k, r in seasons.items()} == want  # below 2^16: exact
    two = parts.where("season < 2").select("season", "player").groupBy().pivot("season", [0, 1]).agg(F.first("player"))
    shared = df.where("season = 0").select("player").intersect(df.where("season = 1").select("player")).count()
    assert abs(two.select(sketches.in_both(F.col("0"), F.col("1")).alias("n")).first().n / shared - 1) < 0.03


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, 7)], "season int, player long, runs long")
    got = sketches.distinct_counts(sketches.distinct_sketches(df, ["season"], ["player"]), ["player"])
    assert sorted((r.season, r.player) for r in got.collect()) == [(1, 0), (2, 1)]
    held = sketches.quantiles(sketches.quantile_sketches(df, ["season"], "runs"), "runs", [0.5])
    assert sorted((r.season, r.p50) for r in held.collect()) == [(1, None), (2, 7)]
    assert sketches.distinct_sketches(df.limit(0), ["season"], ["player"]).count() == 0


def test_quantiles_within_stated_rank_error(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("season"), F.pmod(F.xxhash64("id"), F.lit(10_000_000)).alias("runs"))
    parts = sketches.quantile_sketches(df, ["season"], "runs")
    got = sketches.quantiles(sketches.merge_quantiles(parts, [], "runs"), "runs", [0.1, 0.5, 0.99]).first()
    values = sorted(r.runs for r in df.collect())
    for q, value in ((0.1, got.p10), (0.5, got.p50), (0.99, got.p99)):
        assert abs(sum(v <= value for v in values) / len(values) - q) < 0.004


def test_added_field_is_readable_and_reported(spark):
    texts = ['{"runs": 4, "over": 3}', '{"runs": "six", "wind": {"kmh": 12.5}}', "{broken", None, "[1]", '{"runs": null, "over": 5}']
    df = payloads.with_variant(spark.createDataFrame([(t,) for t in texts], "payload string"))
    assert [r[0] for r in df.select(payloads.field("data", "$.wind.kmh", "double")).collect()] == [None, 12.5, None, None, None, None]
    assert [r[0] for r in df.select(payloads.field("data", "$.runs", "int")).collect()] == [4, None, None, None, None, None]
    rows = payloads.drift(df, _struct(("runs over", INT), ("phase", STRING))).collect()
    assert {(r.field, r.declared, r.found, r.payloads, r.status) for r in rows} == {
        ("runs", "BIGINT", "STRING", 1, "retyped"), ("wind", None, "OBJECT", 1, "added"),
        ("phase", "STRING", None, 0, "missing"), (None, None, None, 3, "unreadable"),
    }
