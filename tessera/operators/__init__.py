"""Relational operators: bridge joins, pivots, shares, joins, keyed updates, profiles."""
from tessera.operators.bridge import bridge_join
from tessera.operators.joins import attach_features, dim_join, first_per_key, lookup_replace, unmatched_keys
from tessera.operators.pivots import (aql_score, count_pivot, domain_frame, domains_of, group_count,
                                      group_mean, indicator_max, indicator_sum, value_counts)
from tessera.operators.profile import (class_distribution, missing_report, null_counts, null_profile, null_rates,
                                       schema_profile)
from tessera.operators.shares import ShareRule, exploded_shares
from tessera.operators.update import update_by_key

__all__ = [
    "bridge_join", "attach_features", "dim_join", "first_per_key", "lookup_replace", "unmatched_keys",
    "aql_score", "count_pivot", "domain_frame", "domains_of", "group_count", "group_mean",
    "indicator_max", "indicator_sum", "value_counts", "class_distribution", "missing_report", "null_counts",
    "null_profile", "null_rates", "schema_profile", "ShareRule", "exploded_shares",
    "update_by_key",
]
