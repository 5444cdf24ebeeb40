"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import math
import pathlib

import pytest

from ebbflow.plans import catalog

DATA = pathlib.Path("/root/testdata/sf0.001")


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, bool) or v is None:
        return v
    if type(v).__name__ in ("int", "Decimal"):
        return float(v)
    return str(v)[:10] if type(v).__name__ in ("date", "datetime", "Timestamp") else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    rows = [[plain(v) for v in r] for r in want.fetchall()]
    got = [[plain(r[c]) for c in names] for r in df.collect()]
    assert len(got) == len(rows)
    for a, b in zip(sorted(got, key=repr), sorted(rows, key=repr)):
        assert a == pytest.approx(b, abs=2e-5) if all(isinstance(x, (float, type(None))) for x in a) else all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 2e-5) for x, y in zip(a, b))


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["segment", "h", "realized"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
