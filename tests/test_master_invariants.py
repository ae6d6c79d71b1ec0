"""Invariants of the master table on the smallest driver tables."""
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import binding as B
from tessera.plans.master import build_master

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def master(spark):
    return build_master(B.Tables(spark, SF)).cache()


def test_one_row_per_report(spark, master):
    n_orders = B.Tables(spark, SF).orders.count()
    assert master.count() == n_orders
    assert master.select("report_id").distinct().count() == n_orders


def test_share_groups_sum_to_one_or_zero(master):
    groups = {}
    for s in B.feature_specs():
        if s.kind == "share":
            groups[s.name] = s.output_columns()
    for name, cols in groups.items():
        total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
        bad = master.where(F.col(cols[0]).isNotNull() & (F.abs(total - 1) > 1e-9) & (F.abs(total) > 1e-9)).count()
        assert bad == 0, name
        # a group is either entirely null or entirely present
        partial = master.where(F.greatest(*[F.col(c).isNull().cast("int") for c in cols])
                               != F.least(*[F.col(c).isNull().cast("int") for c in cols])).count()
        assert partial == 0, name


def test_target_values_and_cert_default(master):
    vals = {r[0] for r in master.select("final_result").distinct().collect()}
    assert vals <= {None, "pass", "!pass"}
    assert master.where(F.col("cert1").isNull()).count() == 0


def test_master_independent_of_shuffle_partitions(spark, master):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = build_master(B.Tables(spark, SF))
        assert sorted(map(tuple, other.collect())) == sorted(map(tuple, master.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
