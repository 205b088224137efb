import duckdb
import pytest

import __spark_entry__ as entry


def test_the_eleven_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_decontamination", "op7_exact_dedup"])
def test_query_equals_its_sql(spark, medium, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{medium}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, medium).toPandas()[list(want.columns)]
    order = lambda f: f.sort_values("doc_id").reset_index(drop=True)
    assert order(got).astype(str).equals(order(want).astype(str))
