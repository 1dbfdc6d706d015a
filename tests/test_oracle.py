"""Every catalogue query against its DuckDB twin on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL

NAMES = sorted(entry.catalog.CATALOG)
DUCK_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    d_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert s_types == d_types
    order = [rel.columns.index(c) for c in df.columns]
    d_rows = Counter(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
    s_rows = Counter(tuple(norm(x) for x in r) for r in df.collect())
    assert s_rows == d_rows


def test_entry_smoke(spark):
    assert entry.entry(spark).count() > 0
