"""The registered queries against their DuckDB SQL."""

import duckdb
import pytest

from learnstream.llm import queries


def test_every_operator_has_its_query():
    assert {int(n.split("_")[0][2:]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_duckdb(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    df = queries.QUERIES[name](spark, small)
    rel = con.sql(queries.SQL[name])
    columns = list(rel.columns)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, rel.fetchall()))
