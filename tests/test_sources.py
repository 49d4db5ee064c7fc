"""Readers, nested documents and the whole batch run."""

import json

import pytest
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.operators.quality import QualityGateError
from matchlake.plans import medallion
from matchlake.sources import io, nested
from matchlake.sources.bronze import new_batch_id, read_raw

from .conftest import match_row


def test_pretty_printed_json_needs_no_inference(spark, tmp_path):
    (tmp_path / "matches.json").write_text(json.dumps([match_row(i) for i in range(4)], indent=2))
    df, bad = read_raw(spark, str(tmp_path), "matches", lines=False)
    assert df.schema == schemas.MATCHES and df.count() == 4 and bad.count() == 0
    assert df.where("season = 2024").count() == 4


def test_json_lines(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text("\n".join(json.dumps(match_row(i)) for i in range(3)))
    assert io.read_json(spark, str(path), schemas.MATCHES, lines=True).count() == 3


def test_bad_records_are_quarantined(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text("\n".join([json.dumps(match_row(0)), '{"match_id": "M1", "season": ', json.dumps(match_row(2))]))
    good, bad = io.read_json_tolerant(spark, str(path), schemas.MATCHES, lines=True)
    assert {r.match_id for r in good.collect()} == {"M0", "M2"}
    row = bad.first()
    assert row.value.startswith('{"match_id": "M1"') and row.file.endswith("m.json")
    assert bad.count() == 1


def test_a_broken_file_is_quarantined_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([match_row(0), match_row(1)], indent=2))
    (tmp_path / "b.json").write_text(json.dumps([match_row(2)], indent=2)[:-5])
    good, bad = io.read_json_tolerant(spark, str(tmp_path), schemas.MATCHES, lines=False)
    assert {r.match_id for r in good.collect()} == {"M0", "M1"}
    assert [r.file.endswith("b.json") for r in bad.collect()] == [True]


def test_merge_schema_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(f"{path}/p=1")
    spark.range(1).withColumn("extra", F.lit("x")).write.parquet(f"{path}/p=2")
    assert "extra" in io.read_table(spark, path, merge_schema=True).columns


def test_batch_id_format():
    import datetime

    assert new_batch_id(datetime.datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"


def document(**info):
    base = {"teams": ["LAK", "BAY"], "season": "2024", "dates": ["2024-04-01", "2024-04-02"], "venue": "Mill Lane",
            "city": "Dunmore", "toss": {"winner": "LAK", "decision": "bat"}, "outcome": {"winner": "LAK"},
            "player_of_match": ["A"], "umpires": ["U1", "U2"]}
    runs = lambda b, e: {"batsman": b, "extras": e, "total": b + e}
    deliveries = [
        {"0.1": {"batsman": "A", "bowler": "Z", "non_striker": "B", "runs": runs(4, 0)}},
        {"0.2": {"batsman": "A", "bowler": "Z", "non_striker": "B", "runs": runs(0, 2), "extras": {"wides": 1, "byes": 1}}},
        {"0.3": {"batsman": "A", "bowler": "Z", "non_striker": "B", "runs": runs(0, 0),
                 "wickets": [{"kind": "run out", "player_out": "B"}, {"kind": "caught", "player_out": "A"}]}},
    ]
    second = [{"0.1": {"batsman": "Z", "wickets": []}}]
    return {"info": base | info,
            "innings": [{"1st innings": {"deliveries": deliveries}}, {"2nd innings": {"deliveries": second}}]}


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document(), indent=1))
    (tmp_path / "b.json").write_text("{ not json")
    (tmp_path / "c.json").write_text(json.dumps({"innings": []}))
    (tmp_path / "d.json").write_text(json.dumps({"info": {"teams": ["VAL"]}, "innings": [{"1": {"deliveries": [{"0.1": {"batsman": "K"}}]}}]}))
    return str(tmp_path)


def test_documents_and_headers(spark, folder):
    docs = nested.read_documents(spark, folder)
    heads = {r.venue: r for r in nested.match_headers(docs).collect()}
    assert set(heads) == {"Mill Lane", ""}
    eden = heads["Mill Lane"]
    assert (eden.gender, eden.match_type, eden.date, eden.teams) == ("male", "T20", "2024-04-01", ["LAK", "BAY"])
    assert eden.outcome == {"winner": "LAK"} and eden.toss.decision == "bat"
    bare = heads[""]
    assert (bare.season, bare.date, bare.umpires) == ("", "", [])
    # The limit counts files, bad ones included.
    assert nested.read_documents(spark, folder, limit=3).count() == 1


def test_deliveries_are_flattened(spark, folder):
    rows = nested.deliveries(nested.read_documents(spark, folder)).collect()
    eden = sorted((r for r in rows if r.venue == "Mill Lane"), key=lambda r: (r.innings, r.over_ball))
    assert [(r.innings, r.over_ball) for r in eden] == [(1, "0.1"), (1, "0.2"), (1, "0.3"), (2, "0.1")]
    assert (eden[0].runs_batsman, eden[0].extras_type, eden[0].is_wicket, eden[0].dismissal_type) == (4, None, False, None)
    assert (eden[1].extras_type, eden[1].extras_value, eden[1].runs_total) == ("wides", 1, 2)
    assert (eden[2].is_wicket, eden[2].dismissal_type, eden[2].dismissed_player) == (True, "run out", "B")
    assert (eden[3].is_wicket, eden[3].runs_total, eden[3].bowler, eden[3].team2) == (False, 0, "", "BAY")
    lone = next(r for r in rows if r.venue == "")
    assert (lone.batsman, lone.team1, lone.team2) == ("K", "VAL", "")


def test_batch_run_end_to_end(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    first = medallion.run(spark, raw_folder, lake, "b1")
    assert first["silver"] == {"matches": 5, "ball_events": 6}
    assert first["gold"]["fact_player_performance/batting"] == 1 and first["gold"]["team_statistics"] == 2
    assert first["warehouse"]["fact_ball_events"] == 6 and first["warehouse"]["dim_team"] == 2
    facts = {n: lake.read(spark, "warehouse", n).drop("_loaded_at").collect() for n in ("fact_ball_events", "fact_match_summary", "fact_player_performance")}
    # The same files again: new load time, same keys, so the facts keep their content.
    medallion.run(spark, raw_folder, lake, "b2")
    for name, rows in facts.items():
        again = lake.read(spark, "warehouse", name).drop("_loaded_at").collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
    pruned = lake.read(spark, "silver", "ball_events").where("season = 2024")
    assert "PartitionFilters: [isnotnull(season" in pruned._jdf.queryExecution().toString()


def test_failed_gate_stops_the_run(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.run(spark, raw_folder, lake, "b1")
    broken = lake.read(spark, "warehouse", "dim_match").withColumn("match_id", F.lit(None).cast("string")).limit(1)
    rows = broken.collect()
    spark.createDataFrame(rows, broken.schema).write.mode("append").parquet(lake.path("warehouse", "dim_match"))
    from matchlake.operators.quality import gate

    with pytest.raises(QualityGateError, match="dim_match.match_id"):
        gate(medallion.warehouse_checks(spark, lake))


def rewritten(raw_folder, tmp_path, **changed):
    """A copy of the raw folder with other lines for some files."""
    import shutil

    folder = tmp_path / f"raw{len(list(tmp_path.iterdir()))}"
    shutil.copytree(raw_folder, folder)
    for name, lines in changed.items():
        (folder / f"{name}.json").write_text("\n".join(lines))
    return str(folder)


def test_an_unchanged_reload_writes_no_facts(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.run(spark, raw_folder, lake, "b1")
    loaded = lake.read(spark, "bronze", "matches").collect()
    second = medallion.run(spark, raw_folder, lake, "b2")
    assert set(second["bronze"].values()) == {0}
    assert sorted(map(str, lake.read(spark, "bronze", "matches").collect())) == sorted(map(str, loaded))
    facts = ("fact_ball_events", "fact_match_summary", "fact_player_performance")
    assert [second["warehouse"][f] for f in facts] == [0, 0, 0]


def test_one_new_match_touches_one_partition(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.run(spark, raw_folder, lake, "b1")
    rows = [json.dumps(match_row(i)) for i in range(5)] + [json.dumps(match_row(9, season=2031, date="2031-05-05"))]
    second = medallion.run(spark, rewritten(raw_folder, tmp_path, matches=rows), lake, "b2")
    assert second["bronze"]["matches"] == 1 and second["warehouse"]["fact_match_summary"] == 1
    assert second["warehouse"]["fact_ball_events"] == 0
    assert lake.read(spark, "warehouse", "fact_match_summary").count() == 6


def test_a_corrected_match_replaces_the_old_one(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.run(spark, raw_folder, lake, "b1")
    rows = [json.dumps(match_row(i, **({"winner": "BAY"} if i == 2 else {}))) for i in range(5)]
    medallion.run(spark, rewritten(raw_folder, tmp_path, matches=rows), lake, "b2")
    winners = {r.match_id: r.winner for r in lake.read(spark, "silver", "matches").collect()}
    assert len(winners) == 5 and winners["M2"] == "BAY" and winners["M1"] == "LAK"


def test_bad_records_are_kept_counted_and_reported(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    rows = [json.dumps(match_row(0)), json.dumps(match_row(1, innings1_runs="lots")), '{"match_id": "M2", ']
    folder = rewritten(raw_folder, tmp_path, matches=rows)
    counts = medallion.run(spark, folder, lake, "b1")
    assert counts["bronze"]["matches"] == 1 and counts["rejected"]["matches"] == 2
    kept = lake.read(spark, "bronze/_quarantine", "matches").collect()
    assert sorted(r.value for r in kept) == sorted(rows[1:]) and {r._batch_id for r in kept} == {"b1"}
    report = spark.read.json(f"{lake.root}/reports/quality")
    failed = report.where("check = 'parse_check' AND dataset = 'matches'").first()
    assert (failed.failures, failed.total, failed.passed) == (2, 3, False)
    assert {"null_check", "duplicate_check", "schema_check", "not_null", "relationships"} <= {r.check for r in report.collect()}
    medallion.run(spark, folder, lake, "b2")
    assert lake.read(spark, "bronze/_quarantine", "matches").count() == 2


def test_a_folder_of_files_is_a_dataset(spark, tmp_path):
    (tmp_path / "matches.json").mkdir()
    for i in range(3):
        (tmp_path / "matches.json" / f"part{i}.json").write_text(json.dumps(match_row(i)))
    good, _ = read_raw(spark, str(tmp_path), "matches")
    assert good.count() == 3


def test_team_history_is_stored(spark, raw_folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))
    assert medallion.run(spark, raw_folder, lake, "b1")["warehouse"]["scd_team_stats"] == 2
    rows = [json.dumps(match_row(i)) for i in range(6)]
    medallion.run(spark, rewritten(raw_folder, tmp_path, matches=rows), lake, "b2")
    history = lake.read(spark, "warehouse", "scd_team_stats").collect()
    assert sorted((r.team_name, r.total_matches, r.valid_to is None) for r in history) == [
        ("BAY", 5, False), ("BAY", 6, True), ("LAK", 5, False), ("LAK", 6, True)]
