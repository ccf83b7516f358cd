"""Every registered query of the library against its SQL, and that it is not vacuous."""

import os

import pytest

from quire.plans import oracle, queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries whose result may be empty on the smallest tables.
SPARSE = {"numbering_gaps"}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(frame, columns):
    def one(v):
        if v is None or v != v or str(v) == "<NA>":
            return "NULL"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(map(tuple, frame[columns].map(one).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    got = queries.queries()[name](spark, DATA).toPandas()
    assert len(got) or name in SPARSE
    sql = oracle.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got, sorted(got.columns)) == plain(want, sorted(got.columns))
