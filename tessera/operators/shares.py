"""Share (ratio) features over count pivots.

A share rule names, per output column, the counts that form its numerator,
and a weight per count for the denominator.  A zero denominator becomes 1
(shares 0); a key missing from the bridge has null counts and keeps null
shares after the left join.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import parse_list_literal, zero_guard


@dataclass(frozen=True)
class ShareRule:
    """``numerators``: output column -> count columns summed on top;
    ``weights``: count column -> weight in the denominator (default 1)."""
    numerators: Mapping[str, Sequence[str]]
    weights: Mapping[str, float] = field(default_factory=dict)

    def denominator(self, counts: Sequence[str]) -> Column:
        total = None
        for c in counts:
            w = self.weights.get(c, 1)
            term = F.col(c) * F.lit(w) if w != 1 else F.col(c)
            total = term if total is None else total + term
        return total

    def columns(self, counts: Sequence[str]) -> list[Column]:
        den = zero_guard(self.denominator(counts)).cast("double")
        out = []
        for name, parts in self.numerators.items():
            num = None
            for p in parts:
                num = F.col(p) if num is None else num + F.col(p)
            out.append((num.cast("double") / den).alias(name))
        return out


def exploded_shares(df: DataFrame, key: str, value: str, domain: Sequence, names: Mapping | None = None,
                    where: Column | None = None, key_alias: str | None = None) -> DataFrame:
    """Shares of each domain value among the non-null *exploded* values.

    List literals (``"['Major', 'Minor']"``) are parsed and exploded, so a
    two-severity finding counts once for each severity; the share of ``v`` is
    ``count(v) / count(non-null)`` with a zero count guarded to 1.  This
    generalises the closed form past two severities.
    """
    if where is not None:
        df = df.where(where)
    k = key_alias or key
    ex = df.select(F.col(key).alias(k), F.explode_outer(parse_list_literal(F.col(value))).alias("__v"))
    v = F.col("__v")
    names = names or {}
    den = zero_guard(F.sum(F.when(v.isNotNull(), 1).otherwise(0))).cast("double")
    aggs = [(F.sum(F.when(v == F.lit(d), 1).otherwise(0)).cast("double") / den).alias(names.get(d, d))
            for d in domain]
    return ex.groupBy(k).agg(*aggs)
