"""Bridge-to-dimension left joins (``bridge A LEFT JOIN dim B ON A.k = B.k``).

The SQL extracts emit the join key twice (``SELECT *``); here the key is
emitted once and only the requested dimension columns are kept, so column
pruning reaches both scans.

Join strategy: dimensions are left to AQE, which converts the sort-merge join
to a broadcast join only when the dimension's runtime size is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise it stays a shuffled join
and AQE splits skewed bridge partitions.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge_join(bridge: DataFrame, dim: DataFrame, bridge_key: str, dim_key: str | None = None,
                keep: Sequence[str] | None = None) -> DataFrame:
    """Left-join ``dim`` onto ``bridge``; output = bridge columns + ``keep``."""
    dim_key = dim_key or bridge_key
    keep = list(keep if keep is not None else dim.columns)
    attrs = [c for c in keep if c != dim_key]
    right = dim.select(F.col(dim_key).alias("__dk"), *attrs)
    joined = bridge.join(right, bridge[bridge_key] == right["__dk"], "left")
    # the dimension key, when kept, is null exactly for bridge rows without a match
    out = [right["__dk"].alias(c) if c == dim_key else right[c] for c in keep]
    return joined.select(*[bridge[c] for c in bridge.columns], *out)
