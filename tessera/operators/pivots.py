"""Per-entity aggregates over bridge rows: count pivots, indicator pivots,
group counts and means.

All pivots take an explicit ``domain``: with it, a pivot is one hash
aggregate of conditional sums (map-side partial aggregation, one shuffle, no
extra job).  ``domains_of`` discovers a domain with one bounded ``distinct``
job when the caller does not know it.  Every aggregate here is algebraic
(sum / max / count / avg), so a hot key holding a third of the rows is
reduced to one partial row per map task before the shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domains_of(df: DataFrame, cols: Sequence[str], exclude: Sequence = (), cap: int = 10_000) -> dict[str, list]:
    """Domains of several columns in ONE distinct job over (column, value) pairs."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v"))
                                          for c in cols])).alias("p")).select("p.*")
    pairs = pairs.where(F.col("v").isNotNull())
    if exclude:
        pairs = pairs.where(~F.col("v").isin(list(exclude)))
    rows = pairs.distinct().limit(cap * len(cols) + 1).collect()
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        out[r["col"]].append(r["v"])
    for c, vals in out.items():
        if len(vals) > cap:
            raise ValueError(f"domain of {c!r} exceeds {cap} values; use a sparse encoding")
    types = dict(df.dtypes)
    return {c: sorted(v if types[c] == "string" else _cast_back(v, types[c]) for v in out[c]) for c in cols}


def _cast_back(v: str, dtype: str):
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        return int(v)
    if dtype in ("double", "float"):
        return float(v)
    return v


def _names(domain: Sequence, names: dict | None, prefix: str) -> list[str]:
    return [(names or {}).get(v, f"{prefix}{v}") for v in domain]


def eq_int(value: Column, v) -> Column:
    """1 when ``value == v``, else 0 (null counts as 0, like a dummy of null)."""
    return F.when(value == F.lit(v), F.lit(1)).otherwise(F.lit(0))


def count_pivot(df: DataFrame, key: str, value: str, domain: Sequence,
                names: dict | None = None, prefix: str = "", where: Column | None = None,
                key_alias: str | None = None) -> DataFrame:
    """Per key, the number of rows whose ``value`` equals each domain value.

    A key whose values are all null (or outside the domain) is kept with
    zeros; ``where`` restricts the rows first (e.g. a phase filter).
    """
    if where is not None:
        df = df.where(where)
    v = F.col(value)
    aggs = [F.sum(eq_int(v, d)).cast("long").alias(n) for d, n in zip(domain, _names(domain, names, prefix))]
    return df.groupBy(F.col(key).alias(key_alias or key)).agg(*aggs)


def indicator_max(df: DataFrame, key: str, value: str, domain: Sequence,
                  names: dict | None = None, prefix: str = "", key_alias: str | None = None) -> DataFrame:
    """Multi-hot 0/1 per key (``get_dummies`` + ``max``).  Null -> 0, not null."""
    v = F.col(value)
    aggs = [F.max(eq_int(v, d)).cast("int").alias(n) for d, n in zip(domain, _names(domain, names, prefix))]
    return df.groupBy(F.col(key).alias(key_alias or key)).agg(*aggs)


def indicator_sum(df: DataFrame, key: str, value: str, domain: Sequence,
                  names: dict | None = None, prefix: str = "", key_alias: str | None = None) -> DataFrame:
    """Dummy counts per key (``get_dummies`` + ``sum``)."""
    v = F.col(value)
    aggs = [F.sum(eq_int(v, d)).cast("long").alias(n) for d, n in zip(domain, _names(domain, names, prefix))]
    return df.groupBy(F.col(key).alias(key_alias or key)).agg(*aggs)


def group_count(df: DataFrame, key: str, col: str, alias: str, where: Column | None = None,
                key_alias: str | None = None) -> DataFrame:
    """Non-null count of ``col`` per key (rows with a phase, say)."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(F.col(key).alias(key_alias or key)).agg(F.count(col).alias(alias))


def group_mean(df: DataFrame, key: str, cols: Sequence[str], names: Sequence[str] | None = None,
               key_alias: str | None = None) -> DataFrame:
    """Mean of each column per key, nulls skipped."""
    names = list(names or cols)
    return df.groupBy(F.col(key).alias(key_alias or key)).agg(
        *[F.avg(F.col(c).cast("double")).alias(n) for c, n in zip(cols, names)])


# AQL severity weights (critical, major, minor).
AQL_WEIGHTS = (3.0, 2.0, 1.0)


def aql_score(df: DataFrame, key: str, crit_acc: str, crit_rej: str, maj_acc: str, maj_rej: str,
              min_acc: str, min_rej: str, alias: str = "aql_score", key_alias: str | None = None) -> DataFrame:
    """``3(critAcc-critRej) + 2(majAcc-majRej) + (minAcc-minRej)`` over per-key means."""
    means = group_mean(df, key, [crit_acc, crit_rej, maj_acc, maj_rej, min_acc, min_rej],
                       ["ca", "cr", "ma", "mr", "na", "nr"], key_alias=key_alias)
    wc, wm, wn = AQL_WEIGHTS
    score = (F.lit(wc) * (F.col("ca") - F.col("cr")) + F.lit(wm) * (F.col("ma") - F.col("mr"))
             + F.lit(wn) * (F.col("na") - F.col("nr")))
    return means.select(key_alias or key, score.alias(alias))


def value_counts(df: DataFrame, key: str, value: str, key_alias: str | None = None) -> DataFrame:
    """Per key, the multiset of values as a sorted array of (value, n).

    The array is bounded by the value domain, not by the group size, so a
    hot key cannot build an unbounded list in one task; the (key, value)
    counts are partially aggregated before the shuffle.
    """
    k = key_alias or key
    counts = df.groupBy(F.col(key).alias(k), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(k).agg(
        F.array_sort(F.collect_list(F.struct("value", "n"))).alias(f"{value}_counts"))


def domain_frame(df: DataFrame, col: str, exclude: Sequence = ("None",), alias: str = "value") -> DataFrame:
    """The pivot domain as a DataFrame: distinct non-null values minus ``exclude``."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(exclude)))
            .select(F.col(col).alias(alias)).distinct())
