"""Every query against its SQL in another engine, on the smallest tables."""

import os

import duckdb
import pytest

from understory.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return c


def _sorted(rows):
    norm = lambda v: None if isinstance(v, float) and v != v else round(v, 9) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    found = db.execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert _sorted(rows) == _sorted([tuple(r[i] for i in order) for r in found.fetchall()])


def test_entry_has_the_result_columns(spark):
    import __spark_entry__
    from understory.operators.results import RESULTS

    df = __spark_entry__.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RESULTS]
    assert df.count() == 4
