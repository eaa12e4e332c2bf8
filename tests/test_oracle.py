"""Every registered query against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, sf, name):
    outcome, _, _ = compare(spark, con, name, sf)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.limit(1).count() == 1
    assert {"query_id", "doc_id", "rank", "score"} <= set(frame.columns)
