"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from tapeworks.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(Q.oracle_sql()[name])
    columns = sorted(d[0] for d in res.description)
    order = [[d[0] for d in res.description].index(c) for c in columns]
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    canon = lambda rows: sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=str)
    assert canon(map(tuple, got.select(*columns).collect())) == canon(tuple(r[k] for k in order) for r in res.fetchall())
