"""Stateful streams: match totals, redelivery, late events, two feeds reconciled."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import state
from matchlake.streaming import live, matchstate

DDL = (
    "event_id string, match_id string, innings int, over int, ball int, runs_scored int, is_wicket boolean, "
    "extras int, extras_type string, kafka_timestamp timestamp"
)
START = datetime(2025, 3, 1, 9)
KEYS = ["match_id", "ball_id", "innings", "over", "ball", "total_runs", "total_wickets", "legal_balls", "target", "match_state"]


class Files:
    """Rows of DDL, a file per micro-batch."""

    def __init__(self, spark, path, ddl=DDL):
        self.spark, self.path, self.ddl, self.n = spark, str(path), ddl, 0

    def put(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.ddl).coalesce(1).write.parquet(f"{self.path}/n={self.n:04d}")

    def stream(self):
        reader = self.spark.readStream.schema(self.ddl).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", True).parquet(self.path)


@pytest.fixture()
def rocks(spark):
    for key, value in live.STATE_STORE_CONF.items():
        spark.conf.set(key, value)
    yield
    for key in live.STATE_STORE_CONF:
        spark.conf.unset(key)


def innings(rng, match, number, start, overs=20):
    rows, clock = [], start
    for over in range(overs):
        for ball in range(6):
            kind = rng.choice(["none"] * 9 + ["wide", "noball", None])
            rows.append((f"{match}-{number}-{over}-{ball}", match, number, over, ball, rng.choice([0, 0, 1, 2, 4, 6]),
                         rng.random() < 0.06, int(kind in ("wide", "noball")), kind, clock))
            clock += timedelta(seconds=20)
    return rows, clock


def season(seed, overs=4):
    rng, rows = random.Random(seed), []
    for k in range(3):
        first, clock = innings(rng, f"M{k}", 1, START + timedelta(seconds=k), overs)
        second, _ = innings(rng, f"M{k}", 2, clock, overs)
        rows += first + second
    rows.sort(key=lambda r: r[-1])
    return rng, rows


def appended(df, name, checkpoint, out):
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query = query.queryName(name).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def expected(spark, rows):
    balls = spark.createDataFrame(rows, DDL).withColumnRenamed("event_id", "ball_id")
    return sorted(map(str, state.with_match_state(state.running_state(balls)).select(*KEYS).collect()))


# The clock of the stream is moved on by a delivery of another match.
TICK = ("tick", "T", 1, 0, 0, 0, False, 0, "none")


@pytest.mark.parametrize("seed,parts", [(1, 2), (2, 5)])
def test_totals_equal_the_batch_in_any_split_and_after_restarts(spark, rocks, tmp_path, seed, parts):
    rng, rows = season(seed)
    # Neighbours overtake each other within the watermark.
    shuffled = sorted(rows, key=lambda r: r[-1] + timedelta(seconds=rng.randrange(0, 28)))
    files = Files(spark, tmp_path / "in")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    cuts = sorted(rng.sample(range(1, len(rows)), parts - 1))
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        files.put(shuffled[lo:hi])
        if rng.random() < 0.5 or hi == cuts[0]:  # stopped, and started again from the checkpoint
            appended(matchstate.running_state(files.stream()), "totals", checkpoint, out)
    files.put([(*TICK, rows[-1][-1] + timedelta(minutes=5))])
    appended(matchstate.running_state(files.stream()), "totals", checkpoint, out)
    got = spark.read.parquet(out).where(~F.col("closed"))
    assert sorted(map(str, got.select(*KEYS).collect())) == expected(spark, rows)


def test_idle_matches_are_closed_and_forgotten(spark, rocks, tmp_path):
    _, rows = season(3, overs=2)
    files = Files(spark, tmp_path / "in")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    files.put(rows)
    for hours in (3, 6):
        files.put([(*TICK, rows[-1][-1] + timedelta(hours=hours))])
    appended(matchstate.running_state(files.stream()), "totals", checkpoint, out)
    closed = spark.read.parquet(out).where("closed AND match_id <> 'T'").collect()
    balls = spark.createDataFrame(rows, DDL)
    sums = balls.groupBy("match_id", "innings").agg(F.sum(state.ball_runs()).alias("runs")).collect()
    assert sorted((r.match_id, r.innings, r.total_runs) for r in closed) == sorted((r.match_id, r.innings, r.runs) for r in sums)
    assert {r.match_state for r in closed} == {"closed"}
    first = {r.match_id: r.runs for r in sums if r.innings == 1}
    assert all(r.target == (first[r.match_id] + 1 if r.innings == 2 else None) for r in closed)


def test_redelivered_events_come_once(spark, tmp_path):
    _, rows = season(4, overs=1)
    files = Files(spark, tmp_path / "in")
    nameless = [(None, *r[1:]) for r in rows[:2]]
    files.put(rows)
    files.put(rows[-5:] + nameless)
    files.put(rows[-3:])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    appended(live.without_redelivery(files.stream(), watermark="1 hour"), "once", checkpoint, out)
    ids = [r.event_id for r in spark.read.parquet(out).collect()]
    assert sorted(i for i in ids if i) == sorted(r[0] for r in rows) and ids.count(None) == 2
    # Far later the old ids have left the state.
    files.put([("later", "M9", *rows[0][2:-1], START + timedelta(days=1))])
    files.put([("x", "M9", *rows[0][2:-1], START + timedelta(days=1))])
    query = live.without_redelivery(files.stream(), watermark="1 hour").writeStream.format("parquet").option("path", out)
    query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_state_stream_from_payloads(spark, rocks, tmp_path):
    """Payloads delivered twice, through decoding and de-duplication, into match states."""
    _, rows = season(7, overs=1)
    raw = "value string, timestamp timestamp"

    def message(r):
        body = dict(zip([c.split()[0] for c in DDL.split(", ")[:-1]], r, strict=False))
        return json.dumps(body), r[-1]

    files = Files(spark, tmp_path / "in", raw)
    files.put([message(r) for r in rows] + [message(r) for r in rows[5:9]])
    files.put([message((*TICK, rows[-1][-1] + timedelta(minutes=5)))])
    query = matchstate.start_state_stream(files.stream(), str(tmp_path / "lake"), str(tmp_path / "cp"), None)
    query.awaitTermination(120)
    assert query.exception() is None
    got = spark.read.parquet(str(tmp_path / "lake/silver/match_state")).where("NOT closed")
    # The feed holds no extras, so none of its deliveries is illegal.
    plain = [(*r[:7], None, None, r[-1]) for r in rows]
    assert sorted(map(str, got.select(*KEYS).collect())) == expected(spark, plain)


def test_late_events_are_kept_apart_and_counted(spark, tmp_path):
    _, rows = season(5, overs=1)
    files = Files(spark, tmp_path / "in")
    files.put(rows[:20])
    files.put([(*TICK, rows[-1][-1] + timedelta(minutes=10))])
    files.put(rows[20:] + [(*TICK[:1], None, *TICK[2:], None)])
    out, checkpoint = str(tmp_path / "split"), str(tmp_path / "cp")

    def run():
        query = matchstate.split_late(files.stream(), out, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(map(tuple, matchstate.late_counts(spark, out).select("batch", "on_time", "late").collect()))

    assert run() == [(0, 20, 0), (1, 1, 0), (2, 1, len(rows) - 20)]
    assert run() == [(0, 20, 0), (1, 1, 0), (2, 1, len(rows) - 20)]
    both = [spark.read.parquet(f"{out}/{n}").select("event_id") for n in ("on_time", "late")]
    assert both[0].union(both[1]).count() == len(rows) + 2


def test_listener_counts_dropped_rows(spark, tmp_path):
    _, rows = season(6, overs=1)
    files = Files(spark, tmp_path / "in")
    files.put(rows[:20])
    files.put([(*TICK, rows[-1][-1] + timedelta(minutes=10))])
    files.put([(*TICK, rows[-1][-1] + timedelta(minutes=10))])
    files.put(rows[20:])
    heard = matchstate.DroppedRows()
    spark.streams.addListener(heard)
    try:
        counts = files.stream().withWatermark("kafka_timestamp", "30 seconds").groupBy(F.window("kafka_timestamp", "10 seconds"))
        appended(counts.count().select("window.start", "count"), "counted", str(tmp_path / "cp"), str(tmp_path / "out"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        for _ in range(50):
            if heard.dropped.get("counted"):
                break
            import time

            time.sleep(0.2)
    finally:
        spark.streams.removeListener(heard)
    assert heard.rows["counted"] == len(rows) + 2 and heard.dropped["counted"] > 0


def test_scores_are_reconciled_with_deliveries(spark, tmp_path):
    ddl = "match_id string, innings int, over int, ball int, total_runs int, kafka_timestamp timestamp"
    at = lambda s: START + timedelta(seconds=s)
    scores, balls = Files(spark, tmp_path / "s", ddl), Files(spark, tmp_path / "d", ddl)
    scores.put([("M", 1, 0, 0, 4, at(0)), ("M", 1, 0, 1, 5, at(20)), ("M", 1, 0, 3, 9, at(60))])
    balls.put([("M", 1, 0, 0, 4, at(3)), ("M", 1, 0, 1, 6, at(22)), ("M", 1, 0, 2, 8, at(40))])
    balls.put([("M", 1, 0, 4, 9, at(80))])
    for k in (1, 2):  # both clocks move on
        scores.put([("T", 1, 0, 0, 0, at(3600 * k))])
        balls.put([("T", 1, 0, 0, 0, at(3600 * k))])
    out = str(tmp_path / "out")
    appended(matchstate.reconciled(scores.stream(), balls.stream()), "met", str(tmp_path / "cp"), out)
    got = spark.read.parquet(out).where("match_id = 'M'").collect()
    assert sorted((r.side, r.ball, r.reported_runs, r.counted_runs, r.agrees) for r in got) == [
        ("both", 0, 4, 4, True), ("both", 1, 5, 6, False), ("delivery", 2, None, 8, None), ("delivery", 4, None, 9, None), ("score", 3, 9, None, None),
    ]
