"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from contrail.sources.tables import TABLES

DATA = "/root/testdata/sf0.001"


def _canon(df):
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False, name=None):
        row = []
        for v in r:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                v = None
            elif hasattr(v, "item"):
                v = v.item()
            if isinstance(v, pd.Timestamp):
                v = v.to_pydatetime()
            row.append(v)
        out.append(tuple(row))
    return cols, sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver test data absent")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, DATA)
    rel = duck.sql(E.oracle_sql()[name])
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = rel.df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_sql():
    from contrail.plans import catalog, oracle_queries
    assert set(catalog.queries()) == set(oracle_queries.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver test data absent")
def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "snapshot_hour"
