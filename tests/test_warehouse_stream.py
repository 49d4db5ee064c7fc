"""The warehouse takes streamed deliveries, and facts and careers follow late ones."""

import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from matchlake.operators import silver, staging, summary, warehouse
from matchlake.plans import medallion
from matchlake.schemas import LIVE_BALL_EVENT
from matchlake.sources import bronze


def delivery(i, runs, match="K1", season=2031, **over):
    row = {"ball_id": f"{match}:{i}", "match_id": match, "season": season, "innings": 1, "over": i // 6, "ball": i % 6,
           "batting_team": "OAK", "bowling_team": "ELM", "batsman": f"Bat{i % 2}", "non_striker": "Bat9", "bowler": "Bowl1",
           "runs_scored": runs, "extras": 0, "extras_type": None, "is_wicket": i == 3, "dismissal_type": None, "phase": "powerplay"}
    return json.dumps(row | over)


def live_row(i, runs, match="K1"):
    values = {"event_id": f"{match}:{i}", "match_id": match, "timestamp": "2031-04-02T10:00:00", "innings": 1, "over": i // 6,
              "ball": i % 6, "batting_team": "OAK", "bowling_team": "ELM", "batsman": f"Bat{i % 2}", "bowler": "Bowl1",
              "runs_scored": runs, "is_wicket": False}
    return tuple(values.get(f) for f in LIVE_BALL_EVENT.fieldNames()) + (datetime(2031, 4, 2, 10),)


def header(match, season):
    return json.dumps({"match_id": match, "season": season, "date": f"{season}-04-02", "venue": "Mill Lane", "city": "Alba",
                       "team1": "OAK", "team2": "ELM", "first_batting": "OAK", "innings1_runs": 30, "innings2_runs": 20, "winner": "OAK"})


def test_streamed_and_late_deliveries_reach_all_facts(spark, tmp_path):
    lake, raw = medallion.Lake(str(tmp_path / "lake")), tmp_path / "raw"
    raw.mkdir()
    files = {"matches": [header("K1", 2031), header("K2", 2030)],
             "players": [json.dumps({"player_id": f"P{n}", "player_name": n}) for n in ("Bat0", "Bat1", "Bowl1", "Bat7")],
             "ball_events": [delivery(i, r) for i, r in enumerate((4, 6, 1, 0))] + [delivery(i, 1, "K2", 2030) for i in range(3)]}
    schema = StructType([*LIVE_BALL_EVENT.fields, StructField("kafka_timestamp", TimestampType())])

    def load(batch, **lines):
        for name, rows in lines.items():
            (raw / bronze.DATASETS[name].file).write_text("\n".join(rows))
            bronze.ingest(spark, str(raw), f"{lake.root}/bronze", name, batch)

    def stream(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(lake.path("stream", "ball_events"))

    def check():
        """Every table equals its rebuild from all deliveries."""
        balls, _ = medallion.warehouse_balls(spark, lake)
        matches = staging.stg_matches(silver.dedupe_latest(lake.read(spark, "bronze", "matches")))
        players = staging.stg_players(silver.dedupe_latest(lake.read(spark, "bronze", "players"), "player_id"))
        want = {"fact_ball_events": warehouse.fact_ball_events(balls), "fact_match_summary": warehouse.fact_match_summary(matches, balls),
                "fact_player_performance": warehouse.fact_player_performance(balls), "dim_player": warehouse.dim_player(players, balls)}
        for name, df in want.items():
            got = lake.read(spark, "warehouse", name)
            columns = [c for c in df.columns if c != "_loaded_at"]
            assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, df.select(*columns).collect())), name
        return {r.match_id: r.total_sixes for r in lake.read(spark, "warehouse", "fact_match_summary").collect()}

    load("b1", **files)
    first = medallion.build_warehouse(spark, lake)
    assert first["fact_ball_events"] == 7 and check() == {"K1": 1, "K2": 0}
    # Deliveries of an old match by stream, one of them loaded before, one delivered twice.
    stream(live_row(3, 0), live_row(4, 6), live_row(5, 6), live_row(5, 6))
    second = medallion.build_warehouse(spark, lake)
    assert second["fact_match_summary"] == 1 and check() == {"K1": 3, "K2": 0}
    # A correction takes away a player's best innings; nothing else changes.
    load("b2", ball_events=[delivery(1, 1)])
    medallion.build_warehouse(spark, lake)
    assert check() == {"K1": 2, "K2": 0}
    careers = lake.read(spark, "marts", "player_careers")
    # A run that dies after the careers are written, before the lines are: the next one sums them again.
    broken = careers.withColumn("runs", F.col("runs") + 5)
    from matchlake.operators.incremental import upsert_table

    upsert_table(broken, lake.path("marts", "player_careers"), ["player_name"], "_at", None)
    assert not summary.CAREERS.agrees(lake.read(spark, "marts", "player_careers"), lake.read(spark, "marts", "player_lines"))
    stream(*[live_row(i, 2) for i in range(6, 10)])
    medallion.build_warehouse(spark, lake)
    check()
