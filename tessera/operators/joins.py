"""Equi left joins of the entity table with dimensions, lookups and
pre-aggregated feature tables.

Feature tables are aggregated to one row per key *before* the join, so no
join can fan out; their output is hash-partitioned on the key, so a chain of
feature joins on the same key re-uses one partitioning of the entity table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_join(master: DataFrame, dim: DataFrame, master_key: str, dim_key: str,
             keep: Sequence[str]) -> DataFrame:
    """``master LEFT JOIN dim``; keep ``keep`` from the dimension, drop its key."""
    right = dim.select(F.col(dim_key).alias("__dk"), *keep)
    return master.join(right, master[master_key] == right["__dk"], "left").drop("__dk")


def attach_features(master: DataFrame, feats: DataFrame, key: str, feat_key: str | None = None,
                    default=None) -> DataFrame:
    """Left-join a one-row-per-key feature table; ``default`` fills keys with
    no feature row (null by default, 0 for the certificate count)."""
    feat_key = feat_key or key
    cols = [c for c in feats.columns if c != feat_key]
    right = feats.withColumnRenamed(feat_key, "__fk")
    out = master.join(right, master[key] == right["__fk"], "left").drop("__fk")
    if default is not None:
        out = out.fillna({c: default for c in cols})
    return out


def first_per_key(lookup: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value of the first row in ``order`` (``.iloc[0]``)."""
    return lookup.groupBy(key).agg(F.min_by(value, order).alias(value))


def lookup_replace(master: DataFrame, lookup: DataFrame, master_key: str, lookup_key: str,
                   lookup_value: str, target: str) -> DataFrame:
    """Rows with a non-null ``master_key`` take the looked-up value in
    ``target``; rows with a null key keep their raw ``target`` value.  A
    non-null key without a lookup row yields null (see ``unmatched_keys``)."""
    right = lookup.select(F.col(lookup_key).alias("__lk"), F.col(lookup_value).alias("__lv"))
    out = master.join(right, master[master_key] == right["__lk"], "left")
    return out.withColumn(target, F.when(F.col(master_key).isNull(), F.col(target))
                          .otherwise(F.col("__lv"))).drop("__lk", "__lv")


def unmatched_keys(master: DataFrame, lookup: DataFrame, master_key: str, lookup_key: str) -> DataFrame:
    """Non-null keys of ``master`` with no lookup row, with their row counts."""
    right = lookup.select(F.col(lookup_key).alias("__lk")).distinct()
    miss = master.where(F.col(master_key).isNotNull()).join(
        right, F.col(master_key) == F.col("__lk"), "left_anti")
    return miss.groupBy(master_key).agg(F.count(F.lit(1)).alias("n_rows"))
