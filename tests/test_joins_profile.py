from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import profile as PR
from tessera.operators.update import update_by_key


def test_lookup_first_row_null_raw_and_unmatched(spark):
    master = spark.createDataFrame([(1, 10, "raw a"), (2, None, "raw b"), (3, 30, "raw c")],
                                   "report_id long, manu_id long, addr string")
    lookup = spark.createDataFrame([(10, "china", 0), (10, "spain", 1), (20, "india", 2)],
                                   "manu_id long, country string, _order long")
    first = J.first_per_key(lookup, "manu_id", "country", "_order")
    out = {r.report_id: r.addr for r in J.lookup_replace(master, first, "manu_id", "manu_id", "country", "addr").collect()}
    assert out == {1: "china", 2: "raw b", 3: None}
    miss = J.unmatched_keys(master, lookup, "manu_id", "manu_id").collect()
    assert [(r.manu_id, r.n_rows) for r in miss] == [(30, 1)]


def test_update_by_key(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "k long, v long")
    up = spark.createDataFrame([(2, 5)], "k long, v long")
    assert sorted(map(tuple, update_by_key(df, up, "k", "v").collect())) == [(1, 0), (2, 5), (3, 0)]


def test_null_profile_and_missing_report(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "c"), (4, 2.0, "d")],
                               "id long, x double, s string")
    prof = {r.column_name: (r.miss_num, r.miss_rate) for r in PR.null_profile(df).collect()}
    assert prof == {"id": (0, 0.0), "x": (2, 0.5), "s": (1, 0.25)}
    rep = [r.column_name for r in PR.missing_report(df).collect()]
    assert rep == ["x", "s"]
    dist = {r.s: r.n for r in PR.class_distribution(df, "s").collect()}
    assert None not in dist and dist["a"] == 1


def test_jdbc_options_partition_the_read():
    import pytest

    from tessera.sources.tables import jdbc_options

    got = jdbc_options("report", "report_id", 1, 5000, 16, url="jdbc:x", user="u")
    assert got == {"url": "jdbc:x", "user": "u", "dbtable": "report", "fetchsize": "10000", "partitionColumn": "report_id",
                   "lowerBound": "1", "upperBound": "5000", "numPartitions": "16"}
    assert "numPartitions" not in jdbc_options("report", url="jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options("report", "report_id", url="jdbc:x")


def test_null_profile_takes_any_column_name(spark):
    df = spark.createDataFrame([(1, None)], "`it's` int, `a b` int")
    assert {r.column_name: r.miss_num for r in PR.null_counts(df).collect()} == {"it's": 0, "a b": 1}
