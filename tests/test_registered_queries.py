"""Every registered query against its DuckDB cross-check on the smallest
scale factor (row count, columns and values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "doc_id", "rank", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, rows) == canon(cols, cur.fetchall())


def test_every_query_has_a_docstring():
    for name, fn in E.queries().items():
        assert fn.__name__, name
