"""Master table: one wide row per report.

Plan shape (per report key):
  report  = orders LEFT JOIN client-dim        (shuffle on client id; AQE may broadcast)
          LEFT JOIN manufacturer-dim, address lookup   (fixed-size, broadcast)
  feats   = ONE aggregate over the line bridge computing all feature groups
  master  = report LEFT JOIN feats               (shuffle on report id)
  target  = ordered substring rules (column expression)
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tessera.functions.scalars import classify_target
from tessera.operators.joins import dim_join, first_per_key, lookup_replace
from tessera.plans import binding as B
from tessera.plans.features import FeatureSpec, attach_specs

REPORT_COLUMNS = ["report_id", "report_date", "product_name", "manu_add", "final_result",
                  "manu_std_name", "client_std_name"]


def report_base(t: B.Tables) -> DataFrame:
    """Report rows with client std name, manufacturer std name and the
    address replaced by the looked-up country (raw text kept for a null id)."""
    rep = dim_join(B.orders_view(t), B.client_dim(t), "client_id", "client_id",
                   ["client_std_name", "manu_id", "manu_add"])
    rep = dim_join(rep, B.manufacturer_dim(t), "manu_id", "manu_id", ["manu_std_name"])
    lookup = first_per_key(B.address_lookup(t), "manu_id", "country", "_order")
    return lookup_replace(rep, lookup, "manu_id", "manu_id", "country", "manu_add")


def feature_sources(t: B.Tables, specs: Sequence[FeatureSpec] | None = None) -> dict[str, tuple[DataFrame, str]]:
    """The line bridge; the part and supplier sides are joined only when a spec reads them
    (Catalyst prunes unused columns but keeps an unused outer join)."""
    specs = list(specs if specs is not None else B.feature_specs())
    supplier = any(s.value in B.SUPPLIER_COLUMNS for s in specs)
    part = any(s.value not in B.LINE_COLUMNS for s in specs)
    return {"lines": (B.with_results(B.line_bridge(t, with_supplier=supplier, with_part=part)), "l_orderkey")}


def build_master(t: B.Tables, specs: Sequence[FeatureSpec] | None = None,
                 keep_report_id: bool = True) -> DataFrame:
    specs = list(specs if specs is not None else B.feature_specs())
    rep = report_base(t).select(*REPORT_COLUMNS)
    out = attach_specs(rep, "report_id", feature_sources(t, specs), specs)
    out = out.withColumn("final_result", classify_target("final_result"))
    feat_cols = [c for s in specs for c in s.output_columns()]
    cols = REPORT_COLUMNS + feat_cols
    if not keep_report_id:
        cols = cols[1:]
    return out.select(*cols)
