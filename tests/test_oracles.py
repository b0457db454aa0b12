"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from evidentia.plans import registry
from tools.check_oracles import TABLES, digest, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(registry.QUERIES) - set(E.oracle_sql()) == set()
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    ddf = duck.execute(E.oracle_sql()[name]).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "doc_id" and len(df.columns) == 28
    assert df.count() == sum(spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages"))
