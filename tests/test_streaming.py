"""Streams over files: equality with batch, late events, restart, replay, bad payloads and fan-out."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.sources import adapter
from matchlake.sources.io import read_table
from matchlake.streaming import live

from .conftest import TESTDATA

RAW_DDL = "value string, timestamp timestamp"
START = datetime(2024, 1, 1, 12)


def event(i, seconds, runs=1, out=False, match="M0", innings=1, **over):
    body = {"event_id": f"E{i}", "match_id": match, "timestamp": "t", "innings": innings, "over": i // 6, "ball": i % 6,
            "batting_team": "LAK", "bowling_team": "BAY", "batsman": "A", "bowler": "Z", "runs_scored": runs,
            "is_wicket": out, "total_runs": i, "total_wickets": 0, "run_rate": 6.0, "match_state": "in_progress"}
    return json.dumps(body | over), START + timedelta(seconds=seconds)


class Feed:
    """A folder of parquet files read as a stream, one file per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.path, self.n = spark, str(root), 0

    def put(self, *rows):
        self.spark.createDataFrame(rows, RAW_DDL).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", 1).parquet(self.path)

    def batch(self):
        return self.spark.read.schema(RAW_DDL).parquet(self.path)


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def rows(df):
    return sorted(map(str, df.collect()))


def stats_columns(df):
    return df.drop("window_hour", "_batch")


def test_decode_and_quarantine(feed):
    feed.put(event(0, 0), ("{ broken", START), ('{"innings": "x"}', START), (None, START))
    good, bad = live.decode(feed.batch()), live.malformed(feed.batch())
    assert [r.event_id for r in good.collect()] == ["E0"]
    assert good.columns == [*live.LIVE_BALL_EVENT.fieldNames(), "kafka_timestamp"]
    assert bad.count() == 3


def test_window_stream_equals_batch_and_restart_changes_nothing(spark, feed, tmp_path):
    feed.put(event(0, 5, 4), event(1, 40, 6), event(2, 41, 0, True))
    feed.put(event(3, 70, 1), event(4, 95, 2, match="M1"))
    out, checkpoint = str(tmp_path / "stats"), str(tmp_path / "cp")

    def run():
        finish(live.stats_sink(live.window_stats(live.decode(feed.stream())), out, checkpoint))
        return rows(stats_columns(read_table(spark, out)).select(*expected.columns))

    expected = live.window_stats(live.decode(feed.batch()))
    assert run() == rows(expected)
    assert run() == rows(expected)
    feed.put(event(5, 100, 4), event(6, 3700, 6))
    assert run() == rows(live.window_stats(live.decode(feed.batch())))


def test_windows_in_an_off_heap_state_store(spark, feed, tmp_path):
    feed.put(event(0, 5, 4), event(1, 40, 6))
    feed.put(event(2, 41, 0, True))
    for key, value in live.STATE_STORE_CONF.items():
        spark.conf.set(key, value)
    try:
        out = str(tmp_path / "stats")
        finish(live.stats_sink(live.window_stats(live.decode(feed.stream())), out, str(tmp_path / "cp")))
    finally:
        for key in live.STATE_STORE_CONF:
            spark.conf.unset(key)
    expected = live.window_stats(live.decode(feed.batch()))
    assert rows(stats_columns(read_table(spark, out)).select(*expected.columns)) == rows(expected)


def test_late_events_are_dropped(spark, feed, tmp_path):
    feed.put(event(0, 0, 1))
    feed.put(event(1, 600, 2))
    feed.put(event(2, 601, 0))  # moves the watermark to 9:31 before the late file is read
    feed.put(event(3, 1, 6))
    out = str(tmp_path / "stats")
    finish(live.stats_sink(live.window_stats(live.decode(feed.stream())), out, str(tmp_path / "cp")))
    first = read_table(spark, out).where(F.col("window_start") == F.lit(START))
    assert [r.runs_in_window for r in first.collect()] == [1]


def test_replayed_batch_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("M0", 1), ("M1", 2)], "match_id string, v int")
    for number in (0, 1, 1):
        live._upsert_batch(batch.withColumn("v", F.col("v") + number), number, path, ["match_id"], None, None, "parquet")
    assert sorted((r.match_id, r.v) for r in read_table(spark, path).collect()) == [("M0", 2), ("M1", 3)]


def test_testdata_events_stream_equals_batch(spark, tmp_path):
    folder = f"{TESTDATA}/sf0.001"
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    query = (
        live.window_stats(adapter.shape_live(stream), "event_time")
        .writeStream.outputMode("update")
        .format("memory")
        .queryName("testdata_stats")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    finish(query)
    expected = live.window_stats(adapter.live_events(spark, folder), "event_time")
    assert rows(spark.table("testdata_stats")) == rows(expected)


def test_fan_out_and_messages(feed):
    feed.put(event(0, 0), event(1, 1, 0, True), event(2, 2, 0, True, dismissal_type="bowled", match_state=None))
    feeds = live.fan_out(live.decode(feed.batch()))
    assert {n: df.count() for n, df in feeds.items()} == {"score": 3, "wicket": 2, "state": 3}
    assert feeds["score"].columns == live.SCORE_COLUMNS
    assert sorted(r.dismissal_type for r in feeds["wicket"].collect()) == ["bowled", "unknown"]
    assert {r.match_state for r in feeds["state"].collect()} == {"in_progress"}
    message = live.as_messages(feeds["state"]).first()
    assert message.key == "M0" and json.loads(message.value)["innings"] == 1


def test_latest_state_batch_and_stream(spark, feed, tmp_path):
    feed.put(event(0, 0), event(7, 7))
    feed.put(event(3, 9, innings=2, match="M1"), event(8, 10, match_state="innings_break"))
    newest = {r.match_id: (r.innings, r.over, r.ball) for r in live.latest_state(live.match_states(live.decode(feed.batch()))).collect()}
    assert newest == {"M0": (1, 1, 2), "M1": (2, 0, 3)}
    out = str(tmp_path / "state")
    states = live.match_states(live.decode(feed.stream()))
    place = F.col("innings") * 1000 + F.col("over") * 6 + F.col("ball")
    query = live.upsert_sink(states.withColumn("place", place), out, str(tmp_path / "cp"), ["match_id"], "place")
    finish(query)
    got = {r.match_id: (r.innings, r.over, r.ball) for r in read_table(spark, out).collect()}
    assert got == newest


def test_all_streams_together(spark, feed, tmp_path):
    feed.put(event(0, 0, 4), event(1, 30, 6), ("broken", START))
    scores = Feed(spark, tmp_path / "scores")
    scores.put(event(0, 0), event(1, 1))
    lake, checkpoints = str(tmp_path / "lake"), str(tmp_path / "cp")
    queries = live.run_all(spark, feed.stream(), scores.stream(), lake, checkpoints, timeout=60, continuous=False)
    for query in queries:
        finish(query)
    spark.streams.resetTerminated()
    assert spark.read.parquet(f"{lake}/stream/ball_events").count() == 2
    assert [r.payload for r in spark.read.parquet(f"{lake}/quarantine/live_ball_events").collect()] == ["broken"]
    assert spark.read.parquet(f"{lake}/quarantine/score_updates").count() == 0
    assert spark.read.parquet(f"{lake}/silver/score_updates").columns == [*live.SCORE_COLUMNS, "kafka_timestamp"]
    stats = read_table(spark, f"{lake}/gold/live_match_stats")
    assert rows(stats_columns(stats).select(live.window_stats(live.decode(feed.batch())).columns)) == rows(
        live.window_stats(live.decode(feed.batch()))
    )
