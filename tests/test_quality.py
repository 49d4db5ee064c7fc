"""Every quality check on passing and failing rows."""

import json

import pytest
from pyspark.sql import functions as F

from matchlake.operators import quality
from matchlake.sources.bronze import ingest_all, with_metadata

from .conftest import ball, match_row


def one(df, **where):
    for column, value in where.items():
        df = df.where(F.col(column) == value)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_null_check(make_matches):
    rows = [match_row(0), match_row(1, winner=None), match_row(2, winner=""), match_row(3, season=None)]
    out = quality.null_check(make_matches(rows), "matches", quality.RAW_RULES["matches"].required)
    winner = one(out, field="winner")
    assert (winner.failures, winner.total, winner.passed, winner.failure_pct) == (2, 4, False, 50.0)
    assert one(out, field="season").failures == 1 and one(out, field="venue").passed
    gone = quality.null_check(make_matches(rows).drop("venue"), "matches", ["venue"]).first()
    assert (gone.failures, gone.passed) == (4, False)
    empty = quality.null_check(make_matches([]), "matches", ["winner"]).first()
    assert (empty.failures, empty.passed, empty.failure_pct) == (0, True, 0.0)


def test_duplicates_count_null_as_one_value(make_matches):
    rows = [match_row(0), match_row(0), match_row(1), match_row(2, match_id=None), match_row(3, match_id=None)]
    out = quality.duplicate_check(make_matches(rows), "matches", "match_id").first()
    assert (out.failures, out.total, out.unique_keys, out.passed) == (2, 5, 3, False)
    assert quality.duplicate_check(make_matches([]), "matches", "match_id").first().passed


def test_schema_check(spark):
    df = spark.createDataFrame([("M0", "2024"), ("M1", "x"), ("M2", None)], "match_id string, season string")
    out = quality.schema_check(df, "matches", ["match_id", "season", "venue"], ["season"])
    assert not one(out, field="venue").passed
    assert one(out, check="type_check", field="season").failures == 1
    assert one(out, check="schema_check", field="season").passed
    empty = quality.schema_check(df.where("false"), "matches", ["venue"], [])
    assert not empty.first().passed


def test_freshness(spark, make_matches, tmp_path):
    at = F.lit("2024-01-03 00:00:00").cast("timestamp")
    loaded = with_metadata(make_matches([match_row(0)]), "s", "b", F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert quality.freshness_check(loaded, "matches", 48, now=at).first().age_hours == 36.0
    assert not quality.freshness_check(loaded, "matches", 35, now=at).first().passed
    assert not quality.freshness_check(loaded.where("false"), "matches", 48, now=at).first().passed
    path = str(tmp_path / "t")
    make_matches([match_row(0)]).write.parquet(path)
    assert quality.freshness_check(spark.read.parquet(path), "matches", 1, by="_file").first().passed


def test_declared_tests(spark, make_balls):
    child = make_balls([ball("B0", match="M0"), ball("B1", match="M9"), ball("B2", match="M9"), ball("B3", match=None)])
    parent = spark.createDataFrame([("M0",), ("M1",)], "match_id string")
    lost = quality.orphans(child, "match_id", parent, "match_id").collect()
    assert [(r.value, r.occurrences) for r in lost] == [("M9", 2)]
    related = quality.relationships(child, "fact", "match_id", parent, "match_id").first()
    assert (related.failures, related.total, related.passed) == (2, 4, False)
    ok = quality.relationships(child.where("match_id = 'M0'"), "fact", "match_id", parent, "match_id").first()
    assert (ok.failures, ok.passed) == (0, True)
    assert one(quality.not_null(child, "fact", ["match_id", "ball_id"]), field="match_id").failures == 1
    assert quality.unique(child, "fact", "match_id").first().failures == 1
    assert quality.unique(child, "fact", "ball_id").first().passed
    assert [tuple(r) for r in quality.unique_violations(child, "match_id").collect()] == [("M9", 2)]
    out = quality.declared_checks({"fact_ball_events": child, "dim_match": parent})
    assert {(r.check, r.dataset, r.field): r.passed for r in out.collect()} == {
        ("not_null", "fact_ball_events", "ball_id"): True,
        ("not_null", "fact_ball_events", "match_id"): False,
        ("relationships", "fact_ball_events", "match_id"): False,
        ("not_null", "dim_match", "match_id"): True,
        ("unique", "dim_match", "match_id"): True,
    }


def test_positive_value(spark):
    df = spark.createDataFrame([(-1,), (-1,), (0,), (5,), (None,)], "runs int")
    assert [tuple(r) for r in quality.positive_value(df, "runs").collect()] == [(-1, 2)]


def test_layers_report_and_gate(spark, raw_folder, tmp_path):
    bronze = str(tmp_path / "bronze")
    loads = ingest_all(spark, raw_folder, bronze, "b1")
    assert {n: x.new for n, x in loads.items()} == {"matches": 5, "ball_events": 6, "players": 7, "teams": 1, "venues": 1}
    assert all(x.read == x.new and x.rejected == 0 for x in loads.values())
    layers = quality.layer_check(spark, bronze)
    assert all(r.passed and r.total > 0 for r in layers.collect())
    quality.gate(layers)
    quality.gate(None)
    missing = quality.layer_check(spark, bronze, ["matches", "umpires"])
    assert {r.dataset: r.passed for r in missing.collect()} == {"matches": True, "umpires": False}
    with pytest.raises(quality.QualityGateError, match="umpires"):
        quality.gate(missing)

    tables = {n: spark.read.parquet(f"{bronze}/{n}") for n in ("matches", "players", "ball_events")}
    checks = quality.raw_checks(tables)
    assert all(r.passed for r in checks.collect())
    report = str(tmp_path / "report")
    first = quality.write_report(checks, report).first()
    assert first.overall_passed and first.total_failures == 0
    bad = quality.write_report(quality.raw_checks(tables | {"players": None}), report).first()
    assert not bad.overall_passed and bad.total_failures == 1
    assert quality.with_message(missing).where("not passed").first().message == "layer_check umpires.files: 1 of 0 (100.0%)"
    lines = [json.loads(line) for f in (tmp_path / "report").glob("*.json") for line in f.read_text().splitlines()]
    assert {"check", "dataset", "field", "failures", "total", "passed", "checked_at"} <= set(lines[0])
