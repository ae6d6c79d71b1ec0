"""Declarative feature groups and their fused aggregation.

Nine near-identical feature blocks of the reference become nine
``FeatureSpec`` rows.  All specs that read the same bridge are computed by
ONE hash aggregate over that bridge (one scan, one shuffle on the key, map-side
partial aggregation), instead of one aggregate and one join per group.

Null/zero semantics kept per group:
* a key with no bridge row (after the spec's ``where``) gets null features,
  or ``default`` when one is given (the certificate count uses 0);
* a key whose rows are all null / outside the domain gets zeros;
* ``remap`` rewrites values before counting (``"None"`` -> ``pass``, buckets);
* values outside ``domain`` -- including the string ``"None"`` when it is not
  remapped -- are not counted, but their rows still make the key present.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.shares import ShareRule

KINDS = ("count", "share", "indicator_max", "indicator_sum", "row_count")


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    source: str
    kind: str
    value: str | None = None
    domain: Sequence = ()
    columns: Mapping = field(default_factory=dict)   # domain value -> output/count column
    where: str | None = None                          # SQL predicate on bridge rows
    share: ShareRule | None = None
    default: object = None
    remap: Callable[[Column], Column] | None = None
    output: str | None = None                         # row_count output column

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown feature kind {self.kind!r}")

    def count_columns(self) -> list[str]:
        return [self.columns.get(v, f"{self.name}_{v}") for v in self.domain]

    def output_columns(self) -> list[str]:
        if self.kind == "row_count":
            return [self.output or self.name]
        if self.kind == "share":
            return list(self.share.numerators)
        return self.count_columns()


def _value(spec: FeatureSpec) -> Column:
    v = F.col(spec.value)
    return spec.remap(v) if spec.remap is not None else v


def _code_column(spec: FeatureSpec) -> Column:
    """Index of the (remapped) value in the spec's domain, null outside it --
    evaluated once per row, so each aggregate below is an int comparison."""
    val = _value(spec)
    out = None
    for i, v in enumerate(spec.domain):
        hit = val == F.lit(v)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return out if out is not None else F.lit(None).cast("int")


def _agg_exprs(spec: FeatureSpec) -> list[Column]:
    """Partial-aggregatable expressions for one spec; internal names are
    prefixed with the spec name so specs never collide."""
    cond = F.expr(spec.where) if spec.where else None
    out = []
    if spec.where:
        out.append(F.count(F.when(cond, F.lit(1))).alias(f"__{spec.name}__n"))
    if spec.kind == "row_count":
        return out if spec.where else [F.count(F.lit(1)).alias(f"__{spec.name}__n")]
    code = F.col(f"__{spec.name}__code")
    for i, c in enumerate(spec.count_columns()):
        hit = code == F.lit(i)
        if cond is not None:
            hit = hit & cond
        one = F.when(hit, F.lit(1)).otherwise(F.lit(0))
        agg = F.max(one) if spec.kind == "indicator_max" else F.sum(one)
        out.append(agg.alias(f"__{spec.name}__{c}"))
    return out


def _final_exprs(spec: FeatureSpec) -> list[Column]:
    """Turn the aggregated internals into the spec's output columns."""
    present = (F.col(f"__{spec.name}__n") > 0) if spec.where else None

    def gate(c: Column, name: str) -> Column:
        return (F.when(present, c) if present is not None else c).alias(name)

    if spec.kind == "row_count":
        return [gate(F.col(f"__{spec.name}__n"), spec.output or spec.name)]
    counts = spec.count_columns()
    if spec.kind == "share":
        local = {c: F.col(f"__{spec.name}__{c}") for c in counts}
        den = None
        for c in counts:
            w = spec.share.weights.get(c, 1)
            term = local[c] * F.lit(w) if w != 1 else local[c]
            den = term if den is None else den + term
        den = F.when(den == 0, F.lit(1)).otherwise(den).cast("double")
        out = []
        for name, parts in spec.share.numerators.items():
            num = None
            for p in parts:
                num = local[p] if num is None else num + local[p]
            out.append(gate(num.cast("double") / den, name))
        return out
    cast = "int" if spec.kind == "indicator_max" else "long"
    return [gate(F.col(f"__{spec.name}__{c}").cast(cast), c) for c in counts]


def aggregate_source(bridge: DataFrame, key: str, specs: Sequence[FeatureSpec],
                     key_alias: str | None = None) -> DataFrame:
    """One hash aggregate computing every spec over one bridge."""
    k = key_alias or key
    codes = {f"__{s.name}__code": _code_column(s) for s in specs if s.kind != "row_count"}
    if codes:
        bridge = bridge.withColumns(codes)
    aggs = [e for s in specs for e in _agg_exprs(s)]
    grouped = bridge.groupBy(F.col(key).alias(k)).agg(*aggs)
    return grouped.select(k, *[e for s in specs for e in _final_exprs(s)])


def attach_specs(master: DataFrame, master_key: str, sources: Mapping[str, tuple[DataFrame, str]],
                 specs: Sequence[FeatureSpec]) -> DataFrame:
    """Left-join every source's fused aggregate onto ``master`` and apply the
    per-spec defaults.  ``sources`` maps a source name to (bridge, key)."""
    by_source: dict[str, list[FeatureSpec]] = {}
    for s in specs:
        by_source.setdefault(s.source, []).append(s)
    out = master
    for src, group in by_source.items():
        bridge, key = sources[src]
        feats = aggregate_source(bridge, key, group, key_alias="__fk")
        out = out.join(feats, out[master_key] == feats["__fk"], "left").drop("__fk")
        fills = {c: s.default for s in group if s.default is not None for c in s.output_columns()}
        if fills:
            out = out.fillna(fills)
    return out
