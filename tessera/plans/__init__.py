"""Declarative feature specs, master assembly, the driver-table binding,
registered queries and their SQL oracle."""
from tessera.plans.features import FeatureSpec, aggregate_source, attach_specs

__all__ = ["FeatureSpec", "aggregate_source", "attach_specs"]
