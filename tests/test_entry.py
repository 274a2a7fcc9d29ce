"""The queries against their SQL on the smallest test tables, where these are there."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry_module
from sparkseg.plans import operators, operators_sql, problems

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = {**operators.QUERIES, **problems.QUERIES}, {**operators_sql.SQL, **problems.SQL}
there = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/seg_result.parquet"), reason="no test tables")


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    return repr(x)


@pytest.fixture(scope="module")
def tables():
    import duckdb

    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


@there
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = tables.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert ours == theirs


@there
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"pipeline_segments"}))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


@there
def test_entry(spark):
    assert entry_module.entry(spark).columns == ["rec_id", "speaker", "kind", "start_ms", "end_ms"]


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
