"""Bucketed facts: joins, groups and windows on the key without an exchange; the same rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchlake.sources import adapter, bucketed

from .conftest import TESTDATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_of_the_fact(spark, tmp_path):
    balls, matches = (f(spark, f"{TESTDATA}/sf0.001") for f in (adapter.balls, adapter.matches))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed.write_bucketed(balls, "bucketed_balls", ["match_id"], 4, ["innings", "over", "ball"], str(tmp_path / "balls"))
        bucketed.write_bucketed(matches, "bucketed_matches", ["match_id"], 4, path=str(tmp_path / "matches"))
        fact, head = spark.table("bucketed_balls"), spark.table("bucketed_matches").select("match_id", "venue")
        running = F.sum("runs_scored").over(Window.partitionBy("match_id", "innings").orderBy("over", "ball", "ball_id"))
        for made in (
            lambda b, m: b.join(m, "match_id").groupBy("match_id", "venue").agg(F.sum("runs_scored").alias("runs")),
            lambda b, m: b.select("match_id", "ball_id", running.alias("runs")),
        ):
            stored, plain = made(fact, head), made(balls, matches.select("match_id", "venue"))
            assert "Exchange" not in plan(stored) and "Exchange" in plan(plain)
            assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS bucketed_balls")
        spark.sql("DROP TABLE IF EXISTS bucketed_matches")


def test_needs_a_key(spark):
    with pytest.raises(ValueError):
        bucketed.write_bucketed(spark.range(3), "none", [], 4)
