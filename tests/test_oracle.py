"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SMOKE
from oracle_check import _rows, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_an_oracle():
    from registry import catalog
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "weather_impact_key" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SMOKE)
    srows = [r.asDict() for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(dcols) == sorted(sdf.columns)
    cols = sorted(dcols)
    assert _rows(srows, cols, True) == _rows(drows, cols, True)
