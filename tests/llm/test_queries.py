"""Registered queries against their SQL, and the contracts of those without SQL."""
import numbers

import duckdb
import pandas as pd
import pytest

from tessera.llm.oracle import SQL
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "embeddings")


def _rows(frame: pd.DataFrame) -> list[tuple]:
    plain = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)
    return sorted((tuple(plain(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_thirteen_operators_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
