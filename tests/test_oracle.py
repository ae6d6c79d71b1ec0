"""Registered queries against their DuckDB oracle on the smallest driver tables."""
import math
import os

import duckdb
import pytest

from tessera.plans.oracle import SQL
from tessera.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "labels", "documents",
          "embeddings"]
# every registered query that has an SQL oracle
FAST = sorted(k for k in SQL if k in REGISTRY)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return str(v)[:19] if hasattr(v, "isoformat") else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    df = REGISTRY[key](spark, SF)
    got = canon(df.collect(), df.columns)
    res = con.execute(SQL[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == canon(res.fetchall(), cols)
