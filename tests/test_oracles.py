"""Every query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def rows(frame):
    plain = lambda v: None if v is None or v is np.nan or v != v else v.item() if isinstance(v, np.generic) else v
    near = lambda v: round(float(v), 6) if isinstance(v, float) else v
    cols = sorted(frame.columns)
    return sorted(repr(tuple(near(plain(v)) if not isinstance(v, str) else v for v in r)) for r in frame[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_its_sql(spark, small, duck, name):
    got, want = entry.queries()[name](spark, small).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    as_number = lambda f: f.apply(lambda c: c.astype(float) if c.dtype.kind in "iu" or str(c.dtype).startswith("Int") else c)
    assert rows(as_number(got)) == rows(as_number(want))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
