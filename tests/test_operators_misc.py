import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.bridge import bridge_join
from tessera.operators.pivots import aql_score, count_pivot, domains_of, value_counts
from tessera.sources.lookup import read_lookup_csv
from tessera.sources.stage import write_table
from tessera.sources.tables import register_catalog


def test_bridge_join_keeps_key_once_and_null_for_unmatched(spark):
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "rid long, tid long")
    dim = spark.createDataFrame([(10, "Major"), (12, "Minor")], "test_id long, result string")
    out = bridge_join(bridge, dim, "tid", "test_id", keep=["test_id", "result"])
    assert out.columns == ["rid", "tid", "test_id", "result"]
    rows = sorted(map(tuple, out.collect()))
    assert rows == [(1, 10, 10, "Major"), (1, 11, None, None), (2, 12, 12, "Minor")]


def test_catalog_prefix(spark):
    df = spark.createDataFrame([(1,)], "a int")
    views = register_catalog({"t": df}, prefix="tessera_test_")
    assert views == {"t": "tessera_test_t"} and spark.table("tessera_test_t").count() == 1


def test_value_counts_and_domains(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k long, v string")
    out = {r.k: [(s.value, s.n) for s in r.v_counts] for r in value_counts(df, "k", "v").collect()}
    assert out == {1: [("a", 1), ("b", 2)], 2: [(None, 1)]}
    assert domains_of(df, ["v"]) == {"v": ["a", "b"]}
    cp = {r.k: (r.n_a, r.n_b) for r in count_pivot(df, "k", "v", ["a", "b"], prefix="n_").collect()}
    assert cp == {1: (1, 2), 2: (0, 0)}


def test_lookup_csv_keeps_file_order(spark):
    src = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, 6, "z")], "line long, manu_id int, country string")
    path = tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp") + "/lk"
    write_table(src.orderBy(F.desc("line")).repartition(3), path, fmt="csv")     # several files, in any order
    lk = read_lookup_csv(spark, path, "line long, manu_id int, country string", order="line")
    assert lk.columns == ["_order", "manu_id", "country"]
    first = {r.manu_id: r.country for r in lk.groupBy("manu_id").agg(F.min_by("country", "_order").alias("country")).collect()}
    assert first == {5: "x", 6: "z"}


def test_lookup_without_a_line_column_raises(spark):
    with pytest.raises(ValueError, match="no column 'line'"):
        read_lookup_csv(spark, "/nowhere", "manu_id int, country string", order="line")


def test_aql_score(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0, 2.0, 1.0, 3.0, 1.0), (1, 3.0, 0.0, 2.0, 1.0, 3.0, 1.0)],
                               "k long, ca double, cr double, ma double, mr double, na double, nr double")
    r = aql_score(df, "k", "ca", "cr", "ma", "mr", "na", "nr").first()
    assert r.aql_score == 3 * 2.0 + 2 * 1.0 + 1 * 2.0
