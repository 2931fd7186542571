"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from trackloom.plans import catalogue

DATA = "/root/testdata/sf0.001"


def canonical(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or v is pd.NA or v != v:
            return "null"
        return repr(round(float(v), 6) + 0.0) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "fiu" else str(v)

    return sorted(tuple(map(text, row)) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.ORACLE_SQL))
def test_oracle(spark, duck, name):
    ours, theirs = catalogue.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.ORACLE_SQL])
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
