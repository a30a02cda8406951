"""Every registered query equals its DuckDB SQL on the sf0.001 tables."""

import duckdb
import pytest

from paths import SF_SMALL
from tools.check_oracle import canon
import __spark_entry__ as entry
from spillway.plans.catalog import QUERIES as CATALOG
from spillway.sources.tables import TABLES

QUERIES = {k: q for k, q in entry.queries().items() if k in CATALOG}  # the training-data queries have their own tests
SQL = {k: s for k, s in entry.oracle_sql().items() if k in CATALOG}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon(ocols, res.fetchall())
    assert c1 == c2
    assert r1 == r2
    assert rows, f"{key} returned no rows"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["topic", "lag"] and df.count() > 0
