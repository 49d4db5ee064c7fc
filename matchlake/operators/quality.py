"""Data-quality checks as aggregations returning result rows.

Every check returns (check, dataset, field, failures, total, passed), so results union into one
report and one gate.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

RESULT_DDL = "check string, dataset string, field string, failures bigint, total bigint, passed boolean"


@dataclass(frozen=True)
class Rules:
    """Declared expectations of one dataset. The rule tables below are fixed values."""

    required: tuple[str, ...] = ()
    key: str | None = None
    expected: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()


RAW_RULES = {
    "matches": Rules(
        required=("match_id", "season", "team1", "team2", "winner", "venue", "date"),
        key="match_id",
        expected=(
            "match_id", "season", "date", "venue", "city", "team1", "team2", "winner", "toss_winner",
            "toss_decision", "innings1_runs", "innings2_runs",
        ),
        numeric=("season", "innings1_runs", "innings2_runs"),
    ),
    "players": Rules(
        required=("player_id", "player_name", "nationality", "role"),
        key="player_id",
        expected=("player_id", "player_name", "nationality", "batting_style", "bowling_style", "role"),
    ),
    "ball_events": Rules(required=("match_id", "innings", "over", "ball", "batsman", "bowler", "runs_scored")),
}

# Declared column tests per table: not_null and unique columns, and (column, parent, parent column).
NOT_NULL = {
    "raw.matches": ("match_id",),
    "raw.ball_events": ("ball_id",),
    "raw.players": ("player_id",),
    "stg_matches": ("match_id", "season", "winner"),
    "stg_ball_events": ("ball_id", "match_id", "runs_scored"),
    "stg_players": ("player_id",),
    "dim_player": ("player_id", "player_name"),
    "dim_team": ("team_id", "team_name"),
    "dim_venue": ("venue_id", "venue_name"),
    "dim_match": ("match_id",),
    "fact_ball_events": ("ball_id", "match_id"),
    "fact_match_summary": ("match_id",),
    "fact_player_performance": ("match_id", "player_name"),
}
UNIQUE = {
    "raw.matches": ("match_id",),
    "raw.players": ("player_id",),
    "stg_matches": ("match_id",),
    "stg_players": ("player_id",),
    "dim_player": ("player_id",),
    "dim_team": ("team_name",),
    "dim_match": ("match_id",),
    "fact_match_summary": ("match_id",),
}
RELATIONSHIPS = {"fact_ball_events": (("match_id", "dim_match", "match_id"),)}

BRONZE_DATASETS = ("matches", "ball_events", "players", "teams", "venues")


# One counter of failing rows: (check, field, count).
Counter = tuple[str, str, Column]


def _results(df: DataFrame, dataset: str, counters: Sequence[Counter]) -> DataFrame:
    """One scan for any number of checks and fields: aggregate wide, then one row per counter."""
    if not counters:
        return df.sparkSession.createDataFrame([], RESULT_DDL)
    counts = [count.cast("bigint").alias(f"_f{i}") for i, (_, _, count) in enumerate(counters)]
    wide = df.agg(F.count("*").alias("_total"), *counts)
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(field).alias("field"), F.col(f"_f{i}").alias("failures"))
        for i, (check, field, _) in enumerate(counters)
    ]
    return wide.select("_total", F.inline(F.array(*rows))).select(
        "check",
        F.lit(dataset).alias("dataset"),
        "field",
        "failures",
        F.col("_total").alias("total"),
        (F.col("failures") == 0).alias("passed"),
    )


def _is_blank(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit(True)
    empty = F.col(column).isNull()
    return empty | (F.col(column) == "") if dict(df.dtypes)[column] == "string" else empty


def _null_counters(df: DataFrame, fields: Sequence[str]) -> list[Counter]:
    return [("null_check", f, F.count_if(_is_blank(df, f))) for f in fields]


def null_check(df: DataFrame, dataset: str, fields: Sequence[str]) -> DataFrame:
    """NULL or empty values per required field, with their percentage."""
    share = F.round(F.try_divide((F.col("failures") * 100).cast("double"), F.col("total").cast("double")), 1)
    counted = _results(df, dataset, _null_counters(df, fields))
    return counted.withColumn("failure_pct", F.coalesce(share, F.lit(0.0)))


def duplicate_check(df: DataFrame, dataset: str, key: str) -> DataFrame:
    """Rows beyond the first per key; a NULL key counts as one value."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failures"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.count("*").alias("unique_keys"),
    ).select(
        F.lit("duplicate_check").alias("check"),
        F.lit(dataset).alias("dataset"),
        F.lit(key).alias("field"),
        "failures",
        "total",
        (F.col("failures") == 0).alias("passed"),
        "unique_keys",
    )


def _schema_counters(df: DataFrame, expected: Sequence[str], numeric: Sequence[str]) -> list[Counter]:
    present = set(df.columns)
    # A missing field fails on every row, and once when there are none.
    every_row = F.greatest(F.count(F.lit(1)), F.lit(1))
    none = F.count_if(F.lit(False))
    counters = [("schema_check", f, none if f in present else every_row) for f in expected]
    for f in numeric:
        if f in present:
            is_number = isinstance(df.schema[f].dataType, NumericType)
            bad = F.col(f).isNotNull() & F.col(f).try_cast("double").isNull()
            counters.append(("type_check", f, none if is_number else F.count_if(bad)))
    return counters


def schema_check(df: DataFrame, dataset: str, expected: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Missing fields, and values of numeric fields that are not numbers, over all rows."""
    return _results(df, dataset, _schema_counters(df, expected, numeric))


def freshness_check(
    df: DataFrame, dataset: str, max_age_hours: float = 48, by: str = "_ingestion_timestamp", now: Column | None = None
) -> DataFrame:
    """Age of the newest row; no rows is a failure. by="_file" uses file modification times."""
    stamp = F.col("_metadata.file_modification_time") if by == "_file" else F.col(by)
    now = F.current_timestamp() if now is None else now
    newest = df.select(stamp.cast("timestamp").alias("_at")).agg(F.max("_at").alias("_at"), F.count("*").alias("total"))
    age = (now.cast("timestamp").cast("double") - F.col("_at").cast("double")) / 3600
    fresh = F.coalesce(age <= max_age_hours, F.lit(False))
    return newest.select(
        F.lit("freshness_check").alias("check"),
        F.lit(dataset).alias("dataset"),
        F.lit(by).alias("field"),
        F.when(fresh, 0).otherwise(1).cast("bigint").alias("failures"),
        "total",
        fresh.alias("passed"),
        F.round(age, 2).alias("age_hours"),
    )


def _readable(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException:
        return None


def layer_check(
    spark: SparkSession, root: str, datasets: Sequence[str] = BRONZE_DATASETS, fmt: str = "parquet"
) -> DataFrame:
    """Each dataset of a layer can be read and has at least one file. Files are listed, no row is read."""
    rows = []
    for name in datasets:
        table = _readable(spark, f"{root}/{name}", fmt)
        files = len(table.inputFiles()) if table is not None else 0
        rows.append(("layer_check", name, "files", int(files == 0), files, files > 0))
    return spark.createDataFrame(rows, RESULT_DDL)


def parse_checks(spark: SparkSession, counts: dict[str, tuple[int, int]]) -> DataFrame:
    """Records that could not be read, of all records, as counted where the text was parsed."""
    rows = [("parse_check", name, "record", bad, total, bad == 0) for name, (bad, total) in counts.items()]
    return spark.createDataFrame(rows, RESULT_DDL)


def not_null(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    return _results(df, dataset, [("not_null", c, F.count_if(F.col(c).isNull())) for c in columns])


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once."""
    found = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return found.agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def unique(df: DataFrame, dataset: str, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.count_if(F.col("_n") > 1).alias("failures"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total")
    ).select(
        F.lit("unique").alias("check"),
        F.lit(dataset).alias("dataset"),
        F.lit(column).alias("field"),
        "failures",
        "total",
        (F.col("failures") == 0).alias("passed"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with their row counts. Child rows are counted per key
    before the join, so a key holding most rows is one row in it."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("occurrences"))
    parents = parent.select(F.col(parent_column).alias("value")).distinct()
    return keys.join(parents, "value", "left_anti")


def relationships(child: DataFrame, dataset: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    total = child.agg(F.count("*")).scalar()
    lost = orphans(child, column, parent, parent_column).agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("failures"))
    return lost.select(
        F.lit("relationships").alias("check"),
        F.lit(dataset).alias("dataset"),
        F.lit(column).alias("field"),
        "failures",
        total.alias("total"),
        (F.col("failures") == 0).alias("passed"),
    )


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Negative values with their counts."""
    bad = df.where(F.col(column) < 0).groupBy(F.col(column).alias("invalid_value"))
    return bad.agg(F.count("*").alias("occurrences"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    fields = [f.split()[0] for f in RESULT_DDL.split(", ")]
    out = None
    for frame in frames:
        out = frame.select(*fields) if out is None else out.unionByName(frame.select(*fields))
    return out


def raw_checks(tables: dict[str, DataFrame | None], max_age_hours: float | None = 48) -> DataFrame:
    """Null, duplicate, schema and freshness checks over raw tables; a missing table fails."""
    frames, missing = [], []
    for name, rules in RAW_RULES.items():
        df = tables.get(name)
        if df is None:
            missing.append(name)
            continue
        counters = _null_counters(df, rules.required) + _schema_counters(df, rules.expected, rules.numeric)
        frames.append(_results(df, name, counters))
        if rules.key:
            frames.append(duplicate_check(df, name, rules.key))
        if max_age_hours is not None and "_ingestion_timestamp" in df.columns:
            frames.append(freshness_check(df, name, max_age_hours))
    if missing:
        spark = next(df for df in tables.values() if df is not None).sparkSession
        frames.append(spark.createDataFrame([("presence", n, "table", 1, 0, False) for n in missing], RESULT_DDL))
    return _union(frames)


def declared_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """The declared not_null, unique and relationships tests of the given tables."""
    frames = []
    for name, df in tables.items():
        if name in NOT_NULL:
            frames.append(not_null(df, name, NOT_NULL[name]))
        frames += [unique(df, name, c) for c in UNIQUE.get(name, ())]
        for column, parent, parent_column in RELATIONSHIPS.get(name, ()):
            frames.append(relationships(df, name, column, tables[parent], parent_column))
    return _union(frames)


def with_message(results: DataFrame) -> DataFrame:
    """A readable line per failed check."""
    share = F.round(F.try_divide((F.col("failures") * 100).cast("double"), F.col("total").cast("double")), 1)
    place = F.concat_ws(".", "dataset", "field")
    text = F.concat(
        F.col("check"), F.lit(" "), place, F.lit(": "), F.col("failures").cast("string"), F.lit(" of "),
        F.col("total").cast("string"), F.lit(" ("), F.coalesce(share, F.lit(100.0)).cast("string"), F.lit("%)"),
    )
    return results.withColumn("message", F.when(~F.col("passed"), text))


def write_report(results: DataFrame, path: str) -> DataFrame:
    """Persists results as JSON and returns the one-row summary read back from them."""
    with_message(results).withColumn("checked_at", F.current_timestamp()).write.mode("append").json(path)
    stored = results.sparkSession.read.schema(RESULT_DDL + ", checked_at timestamp").json(path)
    latest = stored.agg(F.max("checked_at")).scalar()
    return summary(stored.where(F.col("checked_at") == latest))


def summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.bool_and("passed").alias("overall_passed"),
        F.count("*").alias("total_checks"),
        F.count_if(~F.col("passed")).alias("total_failures"),
    )


# Failed checks that a gate's message names.
NAMED = 20


class QualityGateError(RuntimeError):
    """Raised when a check failed and the run must stop."""


def gate(results: DataFrame | None) -> None:
    """Stops the run if any check failed. Absent results pass."""
    if results is None:
        return
    # There is one row per declared rule; the message names some, the stored report all of them.
    names = F.array_sort(F.collect_list(F.concat_ws("", "check", F.lit(":"), "dataset", F.lit("."), "field", F.lit(" ("), F.col("failures").cast("string"), F.lit(")"))))
    count, failed = results.where(~F.col("passed")).agg(F.count("*"), names).first()
    if count:
        shown = ", ".join(failed[:NAMED]) + (f" and {count - NAMED} more, see the report" if count > NAMED else "")
        raise QualityGateError(f"{count} failed checks: {shown}")
