"""Every query of the library against its SQL twin in DuckDB, on the smallest tables."""

from pathlib import Path

import pandas as pd
import pytest

from strandline.plans import catalog

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> list[tuple]:
    cell = lambda v: "NULL" if v is None or (not isinstance(v, (list, dict, str)) and pd.isna(v)) else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(map(cell, row)) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, str(SF)).toPandas()
    if name in catalog.ORACLE_SQL:
        want = duck.execute(catalog.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_twins_are_of_queries():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
