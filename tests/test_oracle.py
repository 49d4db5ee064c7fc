"""Every registered query against its SQL on the supplied tables, types and values exactly, and its
plan against shapes that do not survive large data. Joins run unbroadcast, as they would there."""

import re

import duckdb
import pytest

from matchlake.plans import registry

from .conftest import TESTDATA

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/sf0.001/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), 0 if v is None else v) for v in row))


NUMBERED = ("w4_dim_team", "w5_dim_venue", "r13_team_rankings", "r1_player_listing", "r2_second_page", "r3_match_listing", "r2_page_past_end")


def check_plan(name, text):
    """No cross join, no Python, no window over a whole table."""
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert re.match(r"\w+#\d+L?,", spec) or (name in NUMBERED and spec.startswith("_bucket#")), spec
    # Numbered rows sum one count per bucket in one task, nothing else.
    if name not in NUMBERED:
        assert not re.search(r"Window \[[^\n]*\n[^\n]*(Sort[^\n]*\n[^\n]*)?Exchange SinglePartition", text)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_sql(spark, duck, no_broadcast, name):
    query = registry()[name]
    df = query.run(spark, f"{TESTDATA}/sf0.001")
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    expected = duck.execute(query.oracle())
    columns = [c[0] for c in expected.description]
    types = [TYPES.get(str(c[1]), str(c[1]).lower()) for c in expected.description]
    assert df.columns == columns
    assert [f.dataType.simpleString() for f in df.schema] == types
    assert _sorted(map(tuple, df.collect())) == _sorted(expected.fetchall())


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = set(registry())
    assert names <= set(entry.queries())
    assert names <= set(entry.oracle_sql()) <= set(entry.queries())
