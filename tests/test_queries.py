"""Every registered query against its SQL form on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from folioloom import queries

DIR = "/root/testdata/sf0.001"


def clean(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    found = duck.execute(queries.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    got = sorted(repr([clean(r[c]) for c in names]) for r in df.collect())
    assert got == sorted(repr([clean(r[columns.index(c)]) for c in names]) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_language_stand_in(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang")
    right = queries.langid(spark, DIR).join(docs, "doc_id").selectExpr("avg(cast(label = lang as int))").first()[0]
    assert right > 0.9
