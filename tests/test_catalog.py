"""Every query of the catalogue gives the rows that its SQL gives."""

import duckdb
import pytest

from gleanery import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "nation events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df, names):
    return sorted(str([None if v != v else float(v) if isinstance(v, (int, float)) else v for v in r]) for r in df[names].astype(object).where(df[names].notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
