import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


def _plain(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    got = entry.queries()[name](spark, str(DATA))
    columns = sorted(got.columns)
    ours = sorted(repr([_plain(r[c]) for c in columns]) for r in got.collect())
    asked = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in asked.description]
    assert sorted(names) == columns
    theirs = sorted(repr([_plain(row[names.index(c)]) for c in columns]) for row in asked.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, str(DATA)).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
