"""Raw JSON to bronze tables with ingestion metadata."""

from dataclasses import dataclass
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlake import schemas
from matchlake.sources import changes
from matchlake.sources.io import read_json_tolerant, write_table


@dataclass(frozen=True)
class Dataset:
    file: str
    schema: StructType
    source: str
    key: str
    partition_by: tuple[str, ...] = ()


# File names, source labels and layout are fixed values of the published lake.
DATASETS = {
    "matches": Dataset("matches.json", schemas.MATCHES, "sample_matches", "match_id", ("season",)),
    "ball_events": Dataset("ball_by_ball.json", schemas.BALL_EVENTS, "sample_ball_events", "ball_id", ("season",)),
    "players": Dataset("players.json", schemas.PLAYERS, "sample_players", "player_id"),
    "teams": Dataset("teams.json", schemas.TEAMS, "sample_teams", "team_id"),
    "venues": Dataset("venues.json", schemas.VENUES, "sample_venues", "venue_id"),
}


def new_batch_id(at: datetime | None = None) -> str:
    return (at or datetime.now(UTC)).strftime("%Y%m%d_%H%M%S")


def with_metadata(df: DataFrame, source: str, batch_id: str, at: Column | None = None) -> DataFrame:
    """Ingestion time, date, source and batch id. The batch id is given, so a rerun keeps it."""
    at = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            "_ingestion_timestamp": at,
            "_source": F.lit(source),
            "_ingestion_date": F.to_date(at),
            "_batch_id": F.lit(batch_id),
        }
    )


class Loaded(NamedTuple):
    """Rows of one load: those that were read, those not stored before, and records that could not be read."""

    read: int
    new: int
    rejected: int


def read_raw(spark: SparkSession, raw_path: str, name: str, lines: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good rows, and text and file of records that do not fit the schema. The path may be a file or a folder of
    files. lines=True, one object per line, is read in parallel; otherwise a file is one array and one task."""
    spec = DATASETS[name]
    return read_json_tolerant(spark, f"{raw_path}/{spec.file}", spec.schema, lines)


def _append(spark: SparkSession, rows: DataFrame, path: str, keys, fields, stamp, partition_by, fmt: str) -> int:
    """Appends the rows that change something. Of the stored table, only the partitions are read that may hold one of
    the rows' keys, by the index of keys beside it."""
    marks = changes.with_marks(rows, keys, fields)
    index = f"{path.rpartition('/')[0]}/_keys/{path.rpartition('/')[2]}"
    part = partition_by[0] if partition_by else None
    if changes.exists(spark, index):
        stored = spark.read.format(fmt)
        stored = stored.load(path) if fmt == "delta" else stored.schema(stamp(rows).schema).load(path)
        if part:
            parts = changes.touched_parts(marks, changes.read_index(spark, index))
            stored = stored.where(changes.part_name(part).isin(parts))
        stored = changes.with_marks(stored, keys, fields)
        marks = changes.changed(marks, stored, "_ingestion_timestamp")
    # The rows are read once more for the index, so what they are must not change meanwhile.
    fresh = stamp(marks.drop(*changes.MARKS))
    written = write_table(fresh, path, "append", partition_by, fmt)
    if written or not changes.exists(spark, index):
        changes.add_to_index(changes.with_marks(rows, keys, fields), part, index)
    return written


def ingest(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    name: str,
    batch_id: str,
    lines: bool = True,
    fmt: str = "parquet",
) -> Loaded:
    """Appends the rows of one dataset that differ from the newest stored row of their key, so an unchanged row keeps
    the time of its load, and a value that returns is a change like any other.

    Records that do not parse, or have a value of the wrong type, go to `_quarantine/<name>` with their file.
    """
    spec = DATASETS[name]
    good, bad = read_raw(spark, raw_path, name, lines)
    seen = Observation()

    def stamp(rows: DataFrame) -> DataFrame:
        return with_metadata(rows, spec.source, batch_id)

    good = good.observe(seen, F.count(F.lit(1)).alias("rows"))
    new = _append(spark, good, f"{bronze_path}/{name}", [spec.key], spec.schema.fieldNames(), stamp, spec.partition_by, fmt)
    _append(spark, bad, f"{bronze_path}/_quarantine/{name}", ["value", "file"], ["value", "file"], stamp, (), fmt)
    return Loaded(int(seen.get["rows"]), new, bad.count())


def ingest_all(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    batch_id: str | None = None,
    lines: bool = True,
    fmt: str = "parquet",
) -> dict[str, Loaded]:
    batch_id = batch_id or new_batch_id()
    return {name: ingest(spark, raw_path, bronze_path, name, batch_id, lines, fmt) for name in DATASETS}
