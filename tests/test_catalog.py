"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as E
from hydromart.plans.testbed import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
SKIP = {"fit_logistic", "fit_forest", "score_latest", "coefficients", "reliability"}  # covered by test_quality_ml


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["date", "code_station"] and df.count() > 0
