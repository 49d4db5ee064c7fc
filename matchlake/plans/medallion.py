"""The batch run: raw JSON to bronze, silver, gold and the star schema, with quality gates between."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import gold, quality, silver, staging, summary, warehouse
from matchlake.operators.incremental import newer_than, scd2, table_exists, upsert_table
from matchlake.sources import versions
from matchlake.sources.bronze import Loaded, ingest_all, new_batch_id
from matchlake.sources.io import read_table, write_table
from matchlake.streaming.live import as_ball_events


@dataclass(frozen=True)
class Lake:
    """Folders of the layers under one root."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return read_table(spark, self.path(layer, name), self.fmt)

    def write(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...] = (), **layout) -> int:
        return write_table(df, self.path(layer, name), "overwrite", partition_by, self.fmt, **layout)


def streamed_balls(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Deliveries that came by stream, which has a folder of its own."""
    if not versions.exists(spark, lake.path("stream", "ball_events")):
        return None
    return as_ball_events(lake.read(spark, "stream", "ball_events"))


def build_silver(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Deliveries are stored clustered by match, because nearly every reader groups by it."""
    matches = silver.silver_matches(lake.read(spark, "bronze", "matches"))
    balls = silver.silver_balls(lake.read(spark, "bronze", "ball_events"), streamed_balls(spark, lake))
    return {
        "matches": lake.write(matches, "silver", "matches", ("season",)),
        "ball_events": lake.write(
            balls, "silver", "ball_events", ("season",), cluster_by=("match_id", "innings", "over")
        ),
    }


def build_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    matches, balls = (lake.read(spark, "silver", n) for n in ("matches", "ball_events"))
    tables = {
        "fact_player_performance/batting": (gold.batting_performance(balls), ("season",)),
        "fact_player_performance/bowling": (gold.bowling_performance(balls), ("season",)),
        "fact_match_summary": (gold.match_summary(matches), ("season",)),
        "team_statistics": (gold.team_statistics(matches), ("season",)),
        "venue_analytics": (gold.venue_analytics(matches), ()),
        "toss_analysis": (gold.toss_analysis(matches), ()),
        "powerplay_analysis": (gold.phase_analysis(balls), ("season",)),
    }
    return {name: lake.write(df, "gold", name, parts, rebalance=True) for name, (df, parts) in tables.items()}


def _new_rows(spark: SparkSession, lake: Lake, source: DataFrame, fact: str) -> DataFrame:
    if not table_exists(spark, lake.path("warehouse", fact)):
        return source
    return newer_than(source, lake.read(spark, "warehouse", fact))


def warehouse_balls(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """All staged deliveries, loaded and streamed, and those that the delivery fact does not have yet.

    Loaded rows are told by the high-water mark of their load. Streamed ones have no load time; they are those whose
    id the fact lacks in their season, so only these seasons of the fact are read. A delivery that both have is
    the loaded one, and replaces a streamed row that came first.
    """
    loaded = silver.newest_balls(lake.read(spark, "bronze", "ball_events"))
    streamed = streamed_balls(spark, lake)
    staged = staging.stg_ball_events(loaded)
    fresh = _new_rows(spark, lake, staged, "fact_ball_events")
    if streamed is None:
        return staged, fresh
    once = silver.only_streamed(streamed, loaded).dropDuplicates(["ball_id"])
    late = staging.stg_ball_events(once.withColumn("_ingestion_timestamp", F.lit(None).cast("timestamp")))
    both = staged.unionByName(late)
    if table_exists(spark, lake.path("warehouse", "fact_ball_events")):
        seasons = [r[0] for r in late.select("season").distinct().collect()]
        known = lake.read(spark, "warehouse", "fact_ball_events").where(F.col("season").isin(seasons))
        late = late.join(known.select("ball_id"), "ball_id", "left_anti")
    return both, fresh.unionByName(late.select(*fresh.columns))


def update_careers(spark: SparkSession, lake: Lake, balls: DataFrame, touched: DataFrame) -> DataFrame:
    """Brings the players' careers up to date with the matches in `touched` and returns them.

    Match lines of the touched matches are made anew from their deliveries; the careers take the difference to the
    stored lines, of which only the touched seasons are read. Should a run have died between the two tables, their
    totals differ and the careers are summed again from the lines.
    """
    lines_path, careers_path = lake.path("marts", "player_lines"), lake.path("marts", "player_careers")
    new = summary.player_lines(balls.join(touched, "match_id", "left_semi"))
    if not table_exists(spark, careers_path):
        upsert_table(new, lines_path, ["match_id", "player_name"], "season", "season", lake.fmt, keep_newer=False)
        careers = summary.CAREERS.partial(read_table(spark, lines_path, lake.fmt))
    else:
        stored, held = (read_table(spark, p, lake.fmt) for p in (careers_path, lines_path))
        seasons = [r[0] for r in new.select("season").distinct().collect()]
        old = held.where(F.col("season").isin(seasons)).join(touched, "match_id", "left_semi")
        if not summary.CAREERS.agrees(stored, held):
            stored = summary.CAREERS.partial(held)
        after = held.join(touched, "match_id", "left_anti").unionByName(new.select(*held.columns))
        careers = summary.CAREERS.merged(stored, summary.CAREERS.change(old, new), after)
    version = F.current_timestamp().alias("_at")
    upsert_table(careers.select("*", version), careers_path, ["player_name"], "_at", None, lake.fmt)
    if table_exists(spark, lines_path):
        upsert_table(new, lines_path, ["match_id", "player_name"], "season", "season", lake.fmt, keep_newer=False)
    return read_table(spark, careers_path, lake.fmt)


def store_team_history(spark: SparkSession, lake: Lake, matches: DataFrame) -> int:
    """Adds today's team records to the stored history as a new version, and returns the rows of the history."""
    path, check = lake.path("warehouse", "scd_team_stats"), ["total_matches", "total_wins", "win_percentage"]
    stored = versions.read(spark, path) if versions.current(spark, path) else None
    snapshot = warehouse.team_record(matches).select("team_name", *check)
    history = scd2(stored, snapshot, "team_name", check, F.current_timestamp())
    folders = versions.write_files(history, path, None)
    versions.commit(spark, path, history.schema, folders)
    return versions.read(spark, path).count()


def build_warehouse(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Facts and careers take only deliveries and matches that are new since their last run, loaded or streamed, and
    what these touch; the small dimensions of teams, venues and matches are rebuilt from the matches."""
    matches = staging.stg_matches(silver.dedupe_latest(lake.read(spark, "bronze", "matches")))
    players = staging.stg_players(silver.dedupe_latest(lake.read(spark, "bronze", "players"), "player_id"))
    balls, new_balls = warehouse_balls(spark, lake)
    # A match's summary, a player's line and career need all deliveries of the match, and of no other match. Which
    # matches are touched must be known before the facts take the new rows.
    touched = new_balls.select("match_id").where("match_id IS NOT NULL").distinct()
    new_matches = _new_rows(spark, lake, matches, "fact_match_summary")
    summarised = matches.join(touched.union(new_matches.select("match_id")).distinct(), "match_id", "left_semi")
    affected = balls.join(touched, "match_id", "left_semi")
    own = balls.join(summarised.select("match_id"), "match_id", "left_semi")
    rows: dict[str, int] = {}

    def merge(name: str, delta: DataFrame, keys: list[str]) -> None:
        path = lake.path("warehouse", name)
        rows[name] = upsert_table(delta, path, keys, "_loaded_at", "season", lake.fmt)

    careers = update_careers(spark, lake, balls, touched)
    merge("fact_match_summary", warehouse.fact_match_summary(summarised, own), ["match_id"])
    merge("fact_player_performance", warehouse.fact_player_performance(affected), ["match_id", "player_name"])
    # Last, since what is new is told by what this fact lacks: a run that dies before is done again.
    merge("fact_ball_events", warehouse.fact_ball_events(new_balls), ["ball_id"])
    dims = {
        "dim_player": summary.dim_player(players, careers),
        "dim_team": warehouse.dim_team(matches),
        "dim_venue": warehouse.dim_venue(matches),
        "dim_match": warehouse.dim_match(matches),
    }
    rows |= {name: lake.write(df, "warehouse", name) for name, df in dims.items()}
    rows["scd_team_stats"] = store_team_history(spark, lake, matches)
    return rows


def warehouse_checks(spark: SparkSession, lake: Lake) -> DataFrame:
    names = [n for n in quality.NOT_NULL if n.startswith(("dim_", "fact_"))]
    return quality.declared_checks({n: lake.read(spark, "warehouse", n) for n in names})


def raw_checks(spark: SparkSession, lake: Lake, batch_id: str, loads: dict[str, Loaded]) -> DataFrame:
    """Null, duplicate, schema and parse checks of what this run loaded, and the declared tests of the staged tables."""
    tables = {n: lake.read(spark, "bronze", n) for n in quality.RAW_RULES}
    batch = {n: df.where(F.col("_batch_id") == batch_id) for n, df in tables.items()}
    parsed = quality.parse_checks(spark, {n: (x.rejected, x.read + x.rejected) for n, x in loads.items()})
    staged = quality.declared_checks(
        {
            "stg_matches": staging.stg_matches(silver.dedupe_latest(tables["matches"])),
            "stg_ball_events": staging.stg_ball_events(silver.newest_balls(tables["ball_events"])),
            "stg_players": staging.stg_players(silver.dedupe_latest(tables["players"], "player_id")),
        }
    )
    return quality.raw_checks(batch, max_age_hours=None).unionByName(staged).unionByName(parsed)


def run(
    spark: SparkSession, raw_path: str, lake: Lake, batch_id: str | None = None, lines: bool = True
) -> dict[str, dict]:
    """Every layer in order. A failed gate raises before the next layer is touched; the results of its checks are in
    the report all the same. Records that cannot be read are quarantined, counted and reported, and do not stop it."""
    batch_id = batch_id or new_batch_id()
    report = f"{lake.root}/reports/quality"
    loads = ingest_all(spark, raw_path, f"{lake.root}/bronze", batch_id, lines, lake.fmt)
    counts: dict[str, dict] = {"bronze": {n: x.new for n, x in loads.items()}}
    counts["rejected"] = {n: x.rejected for n, x in loads.items()}
    quality.gate(quality.layer_check(spark, f"{lake.root}/bronze", fmt=lake.fmt))
    checks = raw_checks(spark, lake, batch_id, loads)
    quality.write_report(checks, report)
    quality.gate(checks.where(F.col("check") != "parse_check"))
    counts["silver"] = build_silver(spark, lake)
    counts["gold"] = build_gold(spark, lake)
    counts["warehouse"] = build_warehouse(spark, lake)
    checks = warehouse_checks(spark, lake)
    quality.write_report(checks, report)
    quality.gate(checks)
    return counts


def bronze_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {n: lake.read(spark, "bronze", n) for n in quality.RAW_RULES}
