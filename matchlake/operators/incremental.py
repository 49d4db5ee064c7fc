"""Incremental merge and slowly-changing history over DataFrames and partitioned tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.sources import versions
from matchlake.sources.io import write_table


def newer_than(source: DataFrame, target: DataFrame, high_water: str = "_loaded_at") -> DataFrame:
    """Source rows above the target's high-water mark; all of them while the target is empty."""
    mark = target.agg(F.max(high_water)).scalar()
    return source.where(mark.isNull() | (F.col(high_water) > mark))


def newest_rows(delta: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key, the newest; equal times fall back to a hash of the row.

    Combined before the shuffle, so a key repeated many times sends one row per task."""
    rest = [c for c in delta.columns if c not in keys]
    order = F.struct(F.col(order_col), F.xxhash64(*rest))
    newest = delta.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in delta.columns])


def merge_rows(target: DataFrame, delta: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Target with the delta's newest row per key replacing or joining it."""
    return _replace(target, newest_rows(delta, keys, order_col), keys)


def _replace(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The anti join lets Spark broadcast a small delta's keys and leave the target unshuffled."""
    untouched = target.join(incoming.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(incoming)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a version of the table has been committed."""
    return versions.current(spark, path) is not None or versions.exists(spark, f"{path}/_delta_log")


def upsert_table(
    delta: DataFrame,
    path: str,
    keys: Sequence[str],
    order_col: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    keep_newer: bool = True,
) -> int:
    """Merges delta into the versioned table at path and returns the rows written.

    The delta's newest row per key is written once. With keep_newer a key whose row in the table has a larger
    order_col keeps that row.
    Rewritten are the partitions of the delta and those that now hold one of its keys, so a key may move; the
    others are taken over as they are. The new version is visible as a whole or not at all: a run that dies
    anywhere leaves the version before, and running the same delta again gives the same table. An empty delta makes
    an empty table, or leaves the one there is. With Delta the engine's own MERGE is used.
    """
    spark = delta.sparkSession
    incoming = newest_rows(delta, keys, order_col)
    if fmt == "delta":
        if not table_exists(spark, path):
            return write_table(incoming, path, "overwrite", [partition_by] if partition_by else [], fmt)
        return _delta_merge(incoming, path, keys)
    before = versions.current(spark, path)
    if before is None:
        seen = Observation()
        folders = versions.write_files(incoming.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
        versions.commit(spark, path, incoming.schema, folders)
        return int(seen.get["rows"])
    target = versions.read(spark, path, before)
    staged = versions.write_files(incoming.select(*target.columns), path, None)
    incoming = versions.read(spark, path, before | {"folders": staged})
    if keep_newer:
        same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
        newer = F.col(f"old.{order_col}") > F.col(f"new.{order_col}")
        incoming = incoming.alias("new").join(target.alias("old"), [*same, newer], "left_anti")
    # Partitions are folders of the manifest, so their names are few enough to list.
    part = versions.part_of(partition_by).alias("part")
    homes = target.join(incoming.select(*keys), list(keys), "left_semi").select(part).union(incoming.select(part))
    touched = {r[0] for r in homes.distinct().collect()}
    if not touched:
        return 0
    merged = _replace(versions.read(spark, path, before, touched), incoming.select(*target.columns), keys)
    seen = Observation()
    written = versions.write_files(merged.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
    kept = {name: folder for name, folder in before["folders"].items() if name not in touched}
    versions.commit(spark, path, target.schema, kept | written)
    return int(seen.get["rows"])


def _delta_merge(incoming: DataFrame, path: str, keys: Sequence[str]) -> int:
    from delta.tables import DeltaTable  # optional package

    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    merge = DeltaTable.forPath(incoming.sparkSession, path).alias("t").merge(incoming.alias("s"), on)
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    last = DeltaTable.forPath(incoming.sparkSession, path).history(1).select("operationMetrics.numOutputRows").first()
    return int(last[0] or 0)


def _differs(columns: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    return changed


def scd2(history: DataFrame | None, snapshot: DataFrame, key: str, check: Sequence[str], at: Column) -> DataFrame:
    """History after one more snapshot: changed keys get their open row closed and a new one opened.

    A key missing from the snapshot keeps its open row. valid_to is NULL on open rows. History is
    read once: its closed rows match nothing and pass through.
    """
    no_end = F.nullif(at, at)
    fresh = snapshot.withColumns({"valid_from": at, "valid_to": no_end})
    if history is None:
        return fresh
    same_key = F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
    pair = history.alias("old").join(
        fresh.alias("new"), same_key & F.col("old.valid_to").isNull(), "full_outer"
    )
    is_old, is_new = F.col("old.valid_from").isNotNull(), F.col("new.valid_from").isNotNull()
    changed = is_old & is_new & _differs(check)

    def row(side: str, present: Column, end: Column) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in [*snapshot.columns, "valid_from"]]
        return F.when(present, F.struct(*values, end.alias("valid_to")))

    kept = row("old", is_old, F.when(changed, F.col("new.valid_from")).otherwise(F.col("old.valid_to")))
    opened = row("new", (is_new & ~is_old) | changed, no_end)
    rows = F.filter(F.array(kept, opened), lambda r: r.isNotNull())
    return pair.select(F.inline(rows))


def apply_changes(changes: DataFrame, keys: Sequence[str], sequence: str, deleted: Column) -> DataFrame:
    """The table that a feed of changes describes: per key the row of the largest sequence, whatever order the changes
    come in, and no row where that one deletes. Changes of equal sequence fall back to a hash of the row. Deletions stay
    in the feed as tombstones, so an older change that comes later does not bring a row back."""
    return newest_rows(changes.withColumn("_deleted", deleted), keys, sequence).where(~F.coalesce("_deleted", F.lit(False))).drop("_deleted")


def with_late_snapshot(
    history: DataFrame, snapshot: DataFrame, key: str, check: Sequence[str], at: Column, later: Column
) -> DataFrame:
    """History as if a snapshot of an earlier time `at` had come in its turn.

    later: the time of the next snapshot that was taken, or NULL. Where the snapshot differs from the interval it falls
    into, that interval is split: its old values hold to `at`, the snapshot's values to `later`, and from there the old
    ones again if they were still valid. Intervals that meet with equal values are one. Only the snapshot's keys are
    looked at, the history of one key at a time; all other rows pass through.
    """
    columns = [c for c in snapshot.columns if c != key]
    values = F.struct(*columns)
    mine = history.join(snapshot.select(key).distinct(), key, "left_semi")
    points = mine.select(key, F.col("valid_from").alias("_since"), F.lit(0).alias("_rank"), values.alias("_v"))
    covers = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > later))
    again = mine.where(covers & later.isNotNull()).select(key, later.alias("_since"), F.lit(0).alias("_rank"), values.alias("_v"))
    # At one time the later point counts: a start that was known stays, the snapshot comes before none.
    new = snapshot.select(key, at.alias("_since"), F.lit(1).alias("_rank"), values.alias("_v"))
    one = points.unionByName(again).unionByName(new).groupBy(key, "_since").agg(F.max_by("_v", "_rank").alias("_v"))
    line = Window.partitionBy(key).orderBy("_since")
    told = F.struct(*[F.col(f"_v.{c}") for c in check])
    before = F.lag(told).over(line)
    starts = one.withColumn("_new", before.isNull() | ~before.eqNullSafe(told)).where("_new")
    rebuilt = starts.select(
        key, *[F.col(f"_v.{c}").alias(c) for c in columns], F.col("_since").alias("valid_from"), F.lead("_since").over(line).alias("valid_to")
    )
    rest = history.join(snapshot.select(key).distinct(), key, "left_anti")
    return rest.unionByName(rebuilt.select(*history.columns))


def as_of(facts: DataFrame, history: DataFrame, fact_key: str, at: str, key: str, values: Sequence[str], prefix: str = "then_") -> DataFrame:
    """Facts with the values their key had at the fact's time; NULL where the history has none.

    Intervals are cut at the months they span, so facts and intervals meet by key and month: a key that holds a third of
    all facts is spread over its months, and an interval is compared with facts of its own months only. Open intervals
    end at the newest fact.
    """
    month = lambda c: (F.year(c) * 12 + F.month(c)).cast("int")
    first, last = (facts.agg(f(month(F.col(at)))).scalar() for f in (F.min, F.max))
    spans = history.withColumns(
        {
            "_low": F.greatest(month(F.col("valid_from")), first),
            "_high": F.least(F.coalesce(month(F.col("valid_to")), last), last),
        }
    )
    spans = spans.where(F.col("_low") <= F.col("_high")).select(
        F.col(key).alias("_of"), F.explode(F.sequence("_low", "_high")).alias("_in"), "valid_from", "valid_to",
        *[F.col(v).alias(f"{prefix}{v}") for v in values],
    )
    timed = facts.withColumn("_month", month(F.col(at)))
    inside = (F.col(at) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    met = timed.join(spans, (F.col(fact_key) == F.col("_of")) & (F.col("_month") == F.col("_in")) & inside, "left")
    return met.drop("_month", "_of", "_in", "valid_from", "valid_to")
