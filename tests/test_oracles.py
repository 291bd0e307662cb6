"""Every query against its DuckDB SQL, at the smallest size."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pandas as pd
import pytest

from quillgraph.plans.registry import ORACLES, QUERIES

from .conftest import ROOT, SF


def connection():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame) -> Counter:
    columns = sorted(frame.columns)
    clean = lambda v: None if v is None or pd.isna(v) else int(v) if isinstance(v, float) and v.is_integer() else v
    return Counter(repr(tuple(clean(v) for v in r)) for r in frame[columns].itertuples(index=False, name=None))


def compared(spark, query, sql, con=None) -> None:
    got, expected = query(spark, SF).toPandas(), (con or connection()).execute(sql).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    compared(spark, QUERIES[name], ORACLES[name])
    spark.catalog.clearCache()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_queries_without_the_llm_subpackage():
    """What can't be imported takes none of the other queries along."""
    code = "import sys; sys.modules['tiktoken'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(QUERIES)), str(len(ORACLES))]
