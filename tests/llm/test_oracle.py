import duckdb
import pytest

import __spark_entry__ as entry
from tunetrail.llm import oracle, queries

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(oracle.SQL) <= set(queries.QUERIES) and set(oracle.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(oracle.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    # rows as they are: pandas makes floats of whole numbers where a column holds nulls
    assert sorted(str(tuple(r)) for r in got.select(columns).collect()) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())
