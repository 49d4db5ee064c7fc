"""Physical plans: pruning, pushdown, single scans, early limits and no unbounded single task."""

import re

from matchlake.operators import gold, silver, state
from matchlake.plans import registry
from matchlake.plans.base import Tables
from matchlake.sources.io import read_table

from .conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    text = plan(gold.phase_analysis(Tables(spark, SF).balls))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    lineitem = next(s for s in scans if "l_orderkey" in s)
    assert "l_extendedprice" not in lineitem and "l_suppkey" not in lineitem
    orders = next(s for s in scans if "o_orderkey" in s)
    assert "o_totalprice" not in orders


def test_filter_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan(registry()["s2_filtered_scan"].run(spark, SF))


def test_team_sides_come_from_one_scan(spark, no_broadcast):
    t = Tables(spark, SF)
    stored = spark.createDataFrame([], t.raw_matches.schema)
    text = plan(gold.team_statistics(silver.match_columns(stored)))
    assert len(re.findall(r"Scan ExistingRDD|LocalTableScan", text)) == 1


def test_both_player_roles_come_from_one_scan(spark, no_broadcast):
    text = plan(registry()["w9_player_performance"].run(spark, SF))
    assert text.count("FileScan") == 2  # deliveries and match headers
    assert "FullOuter" not in text


def test_ranked_reads_are_limited_before_the_shuffle(spark):
    for name in ("p5_keyed_dedupe", "d23_recent_deliveries", "d21_dream_team"):
        text = plan(registry()[name].run(spark, SF))
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text), name


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(registry()["d8_top_scorers"].run(spark, SF))


def test_wide_rows_are_hashed_not_sorted_before_the_shuffle(spark, no_broadcast):
    for name in ("g1_batting", "g2_bowling", "w9_player_performance", "e6_match_from_events", "r6_venue_stats"):
        text = plan(registry()[name].run(spark, SF))
        # Plans print top down: a sort-based aggregate may only sit above a hash aggregate of the rows.
        assert text.rindex("SortAggregate") < text.index("HashAggregate"), name


def test_running_totals_split_a_match_over_its_overs(spark, no_broadcast):
    text = plan(state.running_state(Tables(spark, SF).lines))
    assert re.search(r"Window \[sum\(_r#\d+L\) windowspecdefinition\(match_id#\d+L, innings#\d+, over#\d+, ball#", text)


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id % 3 AS season").write.partitionBy("season").parquet(path)
    text = plan(read_table(spark, path).where("season = 1"))
    assert re.search(r"PartitionFilters: \[isnotnull\(season#\d+\), \(season#\d+ = 1\)\]", text)


def test_streamed_windows_combine_before_the_shuffle(spark):
    text = plan(registry()["t3_window_stats"].run(spark, SF))
    assert "partial_sum" in text
