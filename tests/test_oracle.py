"""Every registered query against its DuckDB twin at sf0.001 (the driver does the same at sf0.01)."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from quantsilo.plans import catalog
from quantsilo.sources.tables import TABLES
from paths import SF_SMALL

# the market queries; those of the optional subpackage have their tests beside it
QUERIES = {name: E.queries()[name] for name in catalog.queries()}
SQL = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else
                          (round(float(v), 6) if isinstance(v, float) else
                           (v.isoformat() if hasattr(v, "isoformat") else v)))
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(_norm(got), _norm(want))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    QUERIES[name](spark, SF_SMALL).count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "anomaly_score" in df.columns
