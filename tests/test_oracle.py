"""Every oracle-checked query equals its DuckDB SQL (sf0.001, whole tables)."""
import duckdb
import pytest

import __spark_entry__ as E
from oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    scols = sdf.columns
    srows = rows_of([tuple(r) for r in sdf.collect()], scols)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = rows_of(res.fetchall(), dcols)
    assert sorted(scols) == sorted(dcols)
    assert srows == drows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "platform" in df.columns


def test_every_query_registered_has_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert all(callable(f) for f in qs.values())
