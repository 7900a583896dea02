"""Queries next to their SQL, on the smallest data."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from orderloom.llm.oracles import ORACLES
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(map(tuple, result.fetchall()))
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == want


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names
