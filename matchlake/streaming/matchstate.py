"""Running match state on a live stream, late and redelivered events, and feeds reconciled with each other.

The totals of `operators.state.running_state`, kept by a stateful stream: whatever micro-batches the deliveries
come in, and after a restart, each delivery gets the totals it has in the batch computation. Deliveries wait in
state until the watermark has passed them, so that those which overtook each other are put back in order; then
state holds one row of totals per innings. A match without deliveries for a while is closed by a timer, which
frees its state.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from matchlake.functions import metrics as m
from matchlake.operators import state
from matchlake.streaming import live

IDLE = "2 hours"
PENDING = "ball_id string, innings int, over int, ball int, extras_type string, r bigint, w bigint, l bigint, at bigint"
TOTALS = "r bigint, w bigint, l bigint"
RUNNING = (
    "match_id string, ball_id string, innings int, over int, ball int, extras_type string, total_runs bigint, "
    "total_wickets bigint, legal_balls bigint, target bigint, closed boolean, event_time timestamp"
)
NAMES = [c.split()[0] for c in RUNNING.split(", ")]
# Key of an unknown innings in the map of totals.
UNKNOWN = -1


class MatchTotals(StatefulProcessor):
    """Totals of one match: a list of deliveries that wait for the watermark, a map of innings to totals, and the
    time of the next timer with that of the newest delivery."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.totals = handle.getMapState("totals", "innings int", TOTALS)
        self.clock = handle.getValueState("clock", "due bigint, newest bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in PENDING.split(", ")]
        newest = None
        for part in rows:
            held = part[columns].astype(object).where(part[columns].notna(), None)
            new = [tuple(r) for r in held.itertuples(index=False)]
            newest = max([r[-1] for r in new] + ([newest] if newest is not None else []))
            self.pending.appendList(new)
        due, before = self.clock.get() if self.clock.exists() else (None, None)
        self._wait(due, max(x for x in (newest, before) if x is not None))
        yield pd.DataFrame(columns=NAMES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        newest = self.clock.get()[1]
        rows = list(self.pending.get()) if self.pending.exists() else []
        ready = [r for r in rows if r[-1] <= mark]
        self.pending.clear()
        if len(ready) < len(rows):
            self.pending.put([r for r in rows if r[-1] > mark])
        out = self._released(key[0], ready)
        if newest + self.idle_ms <= mark and len(ready) == len(rows):
            for (innings,), (r, _w, _l) in sorted(self.totals.iterator()):
                out.append((key[0], None, innings, None, None, None, r, _w, _l, self._target(innings), True, newest))
            self.totals.clear()
            self.clock.clear()
        else:
            self._wait(None, newest)
        frame = pd.DataFrame(out, columns=NAMES)
        frame["event_time"] = pd.to_datetime(frame["event_time"], unit="ms", utc=True)
        yield frame

    def close(self) -> None:
        pass

    def _wait(self, due: int | None, newest: int) -> None:
        """One timer a match: for its oldest waiting delivery, or for its end."""
        waiting = [r[-1] for r in self.pending.get()] if self.pending.exists() else []
        wanted = min([*waiting, newest + self.idle_ms])
        if due is not None and due != wanted:
            self.handle.deleteTimer(due)
        if due != wanted:
            self.handle.registerTimer(wanted)
        self.clock.update((wanted, newest))

    def _target(self, innings: int | None) -> int | None:
        if innings != 2:
            return None
        return (self.totals.getValue((1,))[0] if self.totals.containsKey((1,)) else 0) + 1

    def _released(self, match, ready: list[tuple]) -> list[tuple]:
        """Deliveries in playing order with the totals after each. Unknown overs come first, as in the batch."""
        order = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in (r[1], r[2], r[3], r[0]))
        out = []
        for ball in sorted(ready, key=order):
            innings = UNKNOWN if ball[1] is None else ball[1]
            sums = self.totals.getValue((innings,)) if self.totals.containsKey((innings,)) else (0, 0, 0)
            sums = tuple(a + b for a, b in zip(sums, ball[5:8], strict=True))
            self.totals.updateValue((innings,), sums)
            out.append((match, *ball[:5], *sums, self._target(ball[1]), False, ball[8]))
        return out


def running_state(
    events: DataFrame, time_column: str = "kafka_timestamp", watermark: str | None = live.WATERMARK, idle: str = IDLE
) -> DataFrame:
    """Deliveries of a stream with running totals, target and match state, in the order of play, appended once the
    watermark has passed them; and one closed row per innings of a match that was idle. Deliveries that come
    after the watermark are left out here, see `split_late`. Those without a match are too.

    events: ball_id or event_id, match_id, innings, over, ball, runs_scored, is_wicket, and extras and extras_type
    if the feed has them. The state store must be RocksDB (`live.STATE_STORE_CONF`). watermark: None if the time column,
    a timestamp, has one already; Spark allows no second one.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    has = events.columns
    shaped = events.select(
        F.col("match_id").cast("string").alias("match_id"),
        F.col("ball_id" if "ball_id" in has else "event_id").cast("string").alias("ball_id"),
        *[F.col(c).cast("int").alias(c) for c in ("innings", "over", "ball")],
        *[(F.col(c) if c in has else F.lit(None)).cast(t).alias(c) for c, t in (("extras", "int"), ("extras_type", "string"))],
        "runs_scored",
        "is_wicket",
        # A cast column would be without the watermark it has.
        (F.col(time_column) if watermark is None else F.col(time_column).cast("timestamp")).alias("event_time"),
    )
    timed = shaped.where(F.col("match_id").isNotNull() & F.col("event_time").isNotNull())
    counted = timed.select(
        "match_id", "ball_id", "innings", "over", "ball", "extras_type",
        F.coalesce(state.ball_runs(), F.lit(0)).cast("bigint").alias("r"),
        m.is_out().cast("bigint").alias("w"),
        m.is_legal().cast("bigint").alias("l"),
        F.unix_millis("event_time").alias("at"),
        "event_time",
    )
    if watermark is not None:
        counted = counted.withWatermark("event_time", watermark)
    totals = counted.groupBy("match_id").transformWithStateInPandas(
        statefulProcessor=MatchTotals(idle_ms), outputStructType=RUNNING, outputMode="Append", timeMode="EventTime"
    )
    labelled = state.with_match_state(totals)
    return labelled.withColumn("match_state", F.when(F.col("closed"), "closed").otherwise(F.col("match_state")))


def start_state_stream(raw: DataFrame, lake: str, checkpoints: str, every: str | None = live.STATS_TRIGGER, fmt: str = "parquet") -> StreamingQuery:
    """Running state of every delivery, redelivered ones once, to `silver/match_state`."""
    events = live.without_redelivery(live.decode(raw))
    return live.append_sink(running_state(events, watermark=None), f"{lake}/silver/match_state", f"{checkpoints}/match_state", every, fmt)


class LateEvents:
    """Parts a stream's micro-batches into events on time and events behind the watermark, loses none, and counts them.

    The watermark is that of the batches before, as in Spark: the newest event time seen, less the delay. It is
    kept as one row per batch under `path`/_watermarks, so a restarted or replayed batch is split as before.
    """

    def __init__(self, path: str, time_column: str = "kafka_timestamp", delay: str = live.WATERMARK):
        self.path, self.time_column = path, time_column
        self.delay = int(pd.Timedelta(delay).total_seconds() * 1_000_000)

    def _mark(self, spark, batch_id: int) -> int | None:
        marks = spark.read.schema("newest bigint, batch bigint").parquet(f"{self.path}/_watermarks")
        return marks.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = F.max(F.unix_micros(F.col(self.time_column))).alias("newest")
        # Written first, and read back: the folder exists then, and a replay writes the same row.
        batch.agg(newest).write.mode("overwrite").parquet(f"{self.path}/_watermarks/batch={batch_id}")
        mark = self._mark(spark, batch_id)
        behind = F.lit(False) if mark is None else F.unix_micros(F.col(self.time_column)) < mark - self.delay
        late = F.coalesce(behind, F.lit(False))
        rows = batch.withColumn("_late", late)
        for name, wanted in (("on_time", ~F.col("_late")), ("late", F.col("_late"))):
            part = rows.where(wanted).drop("_late")
            part.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")


def split_late(events: DataFrame, path: str, checkpoint: str, time_column: str = "kafka_timestamp", delay: str = live.WATERMARK, every: str | None = None) -> StreamingQuery:
    """Writes the events on time to path/on_time and those behind the watermark to path/late, both by batch."""
    writer = events.writeStream.option("checkpointLocation", checkpoint)
    split = LateEvents(path, time_column, delay)
    return live._timed(writer.foreachBatch(lambda frame, n: split(frame, n)), every).start()


def late_counts(spark, path: str) -> DataFrame:
    """Events on time and late by batch."""
    parts = []
    for name in ("on_time", "late"):
        rows = spark.read.parquet(f"{path}/{name}")
        parts.append(rows.groupBy("batch").agg(F.count("*").alias(name)))
    counted = parts[0].join(parts[1], "batch", "full_outer")
    return counted.select("batch", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("on_time", "late")])


class DroppedRows(StreamingQueryListener):
    """Counts, per query name, the input rows and those that stateful operators dropped behind their watermark."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self.rows[name] = self.rows.get(name, 0) + int(progress.numInputRows)
        gone = sum(int(op.numRowsDroppedByWatermark) for op in progress.stateOperators)
        self.dropped[name] = self.dropped.get(name, 0) + gone

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def reconciled(scores: DataFrame, deliveries: DataFrame, apart: str = "1 minute", watermark: str = live.WATERMARK) -> DataFrame:
    """Score updates joined with the deliveries they report, of two streams: (side, match_id, innings, over, ball,
    reported_runs, counted_runs, agrees). A row without a partner within `apart` comes once its watermark has passed,
    with side "score" or "delivery". Both frames have match_id, innings, over, ball, total_runs and kafka_timestamp."""
    columns = ("match_id", "innings", "over", "ball", "total_runs", "kafka_timestamp")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{name}_{c}") for c in columns]).withWatermark(f"{name}_kafka_timestamp", watermark)

    left, right = side(scores, "s"), side(deliveries, "d")
    near = F.expr(
        f"d_kafka_timestamp BETWEEN s_kafka_timestamp - INTERVAL {apart} AND s_kafka_timestamp + INTERVAL {apart}"
    )
    same = [F.col(f"s_{c}") == F.col(f"d_{c}") for c in ("match_id", "innings", "over", "ball")]
    met = left.join(right, [*same, near], "full_outer")
    both = F.col("s_match_id").isNotNull() & F.col("d_match_id").isNotNull()
    return met.select(
        F.when(both, "both").when(F.col("d_match_id").isNull(), "score").otherwise("delivery").alias("side"),
        *[F.coalesce(f"s_{c}", f"d_{c}").alias(c) for c in ("match_id", "innings", "over", "ball")],
        F.col("s_total_runs").alias("reported_runs"),
        F.col("d_total_runs").alias("counted_runs"),
        F.when(both, F.col("s_total_runs").eqNullSafe(F.col("d_total_runs"))).alias("agrees"),
    )
