"""Keyed updates: the ``df[c][df.key == k] = v`` loop as one left join.

:func:`update_by_key` takes one update a key; :func:`apply_versions` takes any number, in the order of
their versions.  ``tessera.sources.versioned`` applies them to a staged table in place.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_by_key(df: DataFrame, updates: DataFrame, key: str, col: str,
                  update_key: str | None = None, update_col: str | None = None) -> DataFrame:
    """Rows whose key appears in ``updates`` take its value for ``col``;
    others keep theirs.  ``updates`` must be unique per key (pre-aggregate it),
    which makes the loop's last-write-wins order irrelevant."""
    uk, uc = update_key or key, update_col or col
    right = updates.select(F.col(uk).alias("__uk"), F.col(uc).alias("__uv"), F.lit(True).alias("__hit"))
    out = df.join(right, df[key] == right["__uk"], "left")
    return out.withColumn(col, F.when(F.col("__hit"), F.col("__uv")).otherwise(F.col(col))) \
              .drop("__uk", "__uv", "__hit")


def newest(updates: DataFrame, key: str, version: str, cols: Sequence[str]) -> DataFrame:
    """One row a key: the values of its highest version (of equal versions the largest values, so the result is one).

    A maximum, so a key with any number of updates is combined before the shuffle.  Updates without a key touch
    nothing, and those without a version come before all others."""
    order = F.struct(F.coalesce(F.col(version).cast("long"), F.lit(-(1 << 63))).alias("version"), *[F.col(c) for c in cols])
    best = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("best"))
    return best.select(key, *[F.col(f"best.{c}").alias(c) for c in cols])


def apply_versions(df: DataFrame, updates: DataFrame, key: str, version: str, cols: Sequence[str], insert: bool = False) -> DataFrame:
    """``df`` after all of ``updates`` in the order of their versions: the last write to a key wins, nulls included.

    An update sets every column of ``cols``; ``insert`` adds keys that ``df`` lacks (other columns null), else
    their updates touch nothing."""
    last = newest(updates, key, version, cols)
    right = last.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in cols], F.lit(True).alias("__hit"))
    out = df.join(right, df[key] == right["__key"], "full" if insert else "left")
    hit = F.coalesce("__hit", F.lit(False))
    values = [F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in cols
              else F.coalesce(F.col(c), F.col("__key")).alias(c) if c == key and insert else F.col(c) for c in df.columns]
    return out.select(*values)
