"""The driver's contract on the smallest tables, against DuckDB."""

import os

import pytest

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 5)
    if hasattr(v, "replace") and hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_queries_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from granary.plans import queries

    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, f in queries.QUERIES.items():
        got = f(spark, SF)
        rows = got.collect()
        if name in queries.ORACLE:
            r = con.execute(queries.ORACLE[name])
            cols = [c[0] for c in r.description]
            assert sorted(cols) == sorted(got.columns), name
            at = [cols.index(c) for c in got.columns]
            want = sorted(repr(tuple(norm(x[i]) for i in at)) for x in r.fetchall())
            assert sorted(repr(tuple(map(norm, x))) for x in rows) == want, name


def test_entry(spark):
    import __spark_entry__

    if os.path.isdir(SF):
        assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
