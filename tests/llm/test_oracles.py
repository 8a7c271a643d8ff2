"""The queries that have SQL, against DuckDB on the smallest tables."""
from collections import Counter

import duckdb
import pytest
from sonora.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf001, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    got, want = QUERIES[name](spark, sf001), con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())
