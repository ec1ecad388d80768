"""Every query of the engine against its SQL on the small tables."""

import decimal
import glob
import math
import os

import duckdb
import pytest

import genoframe.plans.divergence  # noqa: F401
import genoframe.plans.files  # noqa: F401
import genoframe.plans.more  # noqa: F401
import genoframe.plans.structure  # noqa: F401
from genoframe.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(v):
    if v is None:
        return (0,)
    if isinstance(v, (bool, int, float, decimal.Decimal)):
        v = float(v)
        return (0,) if math.isnan(v) else (1, round(v, 6) + 0.0)
    return (2, str(v))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, tables, name):
    df = registry.queries()[name](spark, SF)
    own = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    result = tables.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    other = sorted(tuple(plain(v) for _, v in sorted(zip(columns, row))) for row in result.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert own == other
    assert own


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
