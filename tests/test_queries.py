"""Every query of the catalogue against its DuckDB oracle, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from lexweave import catalog

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.iterdir():
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5) + 0.0
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def rows(found):
    return sorted((tuple(map(plain, r)) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(SF))
    want = duck.sql(catalog.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert rows(df.select(*columns).collect()) == rows(want.select(*(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - {"cycle_break"}))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, str(SF)).count() >= 0


def test_no_python_in_built_in_queries(spark):
    for name in ("doc_readability", "ngram_df_filler", "edge_dedup", "wic_easy"):
        plan = catalog.QUERIES[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan
