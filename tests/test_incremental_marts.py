"""Change capture, summaries by delta, late snapshots and the as-of join against rebuilds."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import incremental, summary
from matchlake.sources import bronze, changes

SQUAD = "player_id player_name nationality date_of_birth batting_style bowling_style role ipl_debut_year".split()


def rows(df, *columns):
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


def season_row(match, season, **over):
    return json.dumps({"match_id": match, "season": season, "winner": "OAK", "venue": "Mill Lane"} | over)


@pytest.fixture()
def loader(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()

    def load(name, lines, batch):
        (raw / bronze.DATASETS[name].file).write_text("\n".join(lines))
        return bronze.ingest(spark, str(raw), lake, name, batch)

    load.path = lake
    return load


def test_a_value_that_returns_is_a_change(spark, loader):
    player = lambda role: json.dumps(dict.fromkeys(SQUAD) | {"player_id": "P1", "player_name": "Ina Roe", "role": role, "ipl_debut_year": 2019})
    other = json.dumps(dict.fromkeys(SQUAD) | {"player_id": "P2", "player_name": "Uwe Tal"})
    loads = [loader("players", [player(role), other], f"b{k}").new for k, role in enumerate(("Keeper", "Bowler", "Keeper", "Keeper"))]
    assert loads == [2, 1, 1, 0]
    stored = spark.read.parquet(f"{loader.path}/players")
    from matchlake.operators.silver import dedupe_latest

    assert {r.player_id: r.role for r in dedupe_latest(stored, "player_id").collect()} == {"P1": "Keeper", "P2": None}


def test_a_load_reads_touched_partitions_only(spark, loader):
    lines = [season_row(f"K{k}", 2001 + k) for k in range(6)]
    assert loader("matches", lines, "b0").new == 6
    # K2 changes, K3 moves to another season, K9 is new.
    changed = [season_row("K2", 2003, winner="ELM"), season_row("K3", 2011), season_row("K9", 2012), season_row("K4", 2005)]
    index = changes.read_index(spark, f"{loader.path}/_keys/matches")
    frame = spark.createDataFrame([("K2",), ("K3",), ("K9",), ("K4",)], "match_id string")
    marked = changes.with_marks(frame, ["match_id"], ["match_id"])
    assert sorted(changes.touched_parts(marked, index)) == ["2003", "2004", "2005"]
    # The other seasons' files may even be gone.
    import shutil

    for season in (2001, 2002, 2006):
        shutil.rmtree(f"{loader.path}/matches/season={season}")
    assert loader("matches", changed, "b1").new == 3
    assert loader("matches", changed, "b2").new == 0
    # K3 goes back to its first season: its newest row is in another partition now.
    assert loader("matches", [season_row("K3", 2004)], "b3").new == 1


def test_rows_without_a_key_stay_once(loader):
    lines = [season_row(None, 2001), season_row(None, 2001, winner="ELM"), season_row(None, 2001)]
    assert [loader("matches", lines, f"b{k}").new for k in range(2)] == [3, 0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summary_equals_a_rebuild_after_any_changes(spark, seed):
    """Insertions, corrections and deletions, lost maxima, nulls in keys and values, keys that end."""
    rng = random.Random(seed)
    ddl = "id int, team string, runs bigint, best bigint"
    model = summary.Summary(("team",), ("runs",), ("best",))
    new = lambda i: (i, rng.choice(["a", "b", "c", None, f"t{i}"]), rng.choice([None, rng.randrange(90)]), rng.choice([None, rng.randrange(9)]))
    detail = {i: new(i) for i in range(30)}
    stored = model.partial(spark.createDataFrame(list(detail.values()), ddl))
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    for step in range(3):
        touched = rng.sample(sorted(detail), 8)
        old = [detail[i] for i in touched]
        for i in touched[:4]:
            del detail[i]
        fresh = [new(i) for i in [*touched[4:], *range(100 * step + 100, 100 * step + 104)]]
        detail |= {r[0]: r for r in fresh}
        after = spark.createDataFrame(list(detail.values()), ddl)
        change = model.change(spark.createDataFrame(old, ddl), spark.createDataFrame(fresh, ddl))
        merged = model.merged(stored, change, after)
        assert {r.team for r in merged.collect()} == {r[1] for r in [*old, *fresh]}
        stored = model.replaced(stored, merged)
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        # A sum of no values may be 0 or null, by the way it came to be.
        shown = ["team", "_rows", F.coalesce("runs", F.lit(0)), "best"]
        assert rows(stored, *shown) == rows(model.partial(after), *shown)
        assert model.agrees(stored, after)
    assert not model.agrees(stored.limit(2), after)


def test_changes_in_any_order_with_tombstones(spark):
    feed = [("a", 1, False, "x"), ("a", 3, False, "z"), ("a", 2, True, "y"), ("b", 5, True, "q"), ("b", 4, False, "p"), ("c", 1, None, "n")]
    for order in (feed, feed[::-1]):
        df = spark.createDataFrame(order, "k string, at int, gone boolean, v string")
        got = incremental.apply_changes(df, ["k"], "at", F.col("gone"))
        assert sorted((r.k, r.v) for r in got.collect()) == [("a", "z"), ("c", "n")]


@pytest.mark.parametrize("seed", [1, 2])
def test_late_snapshots_give_the_history_of_their_turn(spark, seed):
    rng = random.Random(seed)
    days = [datetime(2020, 1, 1) + timedelta(days=40 * k) for k in range(6)]
    taken = [{k: rng.randrange(3) for k in "abcde"[: 2 + n // 2]} for n in range(6)]
    frame = lambda n: spark.createDataFrame(sorted(taken[n].items()), "k string, v int")
    at = lambda n: F.lit(days[n].isoformat()).cast("timestamp_ntz")

    def history(turns):
        out = None
        for n in turns:
            out = incremental.scd2(out, frame(n), "k", ["v"], at(n))
        return out

    for late in (0, 3, 5):
        rest = [n for n in range(6) if n != late]
        following = at(late + 1) if late < 5 else F.lit(None).cast("timestamp_ntz")
        got = incremental.with_late_snapshot(history(rest), frame(late), "k", ["v"], at(late), following)
        assert rows(got, "k", "v", "valid_from", "valid_to") == rows(history(range(6)), "k", "v", "valid_from", "valid_to")


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(8)
    start = datetime(2021, 1, 1)
    spans = []
    for k in "abc":
        cuts = sorted(rng.sample(range(0, 900), 5))
        spans += [(k, n, start + timedelta(days=lo), start + timedelta(days=hi) if hi else None) for n, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], None], strict=True))]
    facts = [(i, rng.choice(["a", "a", "a", "b", "c", "z", None]), start + timedelta(days=rng.randrange(-50, 1000), seconds=rng.randrange(2))) for i in range(300)]
    history = spark.createDataFrame(spans, "k string, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    frame = spark.createDataFrame(facts, "id int, team string, at timestamp_ntz")
    got = incremental.as_of(frame, history, "team", "at", "k", ["v"])
    assert got.columns == ["id", "team", "at", "then_v"]
    want = {i: next((v for kk, v, lo, hi in spans if kk == k and lo <= t and (hi is None or t < hi)), None) for i, k, t in facts}
    assert {r.id: r.then_v for r in got.collect()} == want and got.count() == len(facts)
    assert incremental.as_of(frame.limit(0), history, "team", "at", "k", ["v"]).count() == 0
