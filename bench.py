"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced end to end with the ``noop`` sink (full computation,
nothing collected to the driver).  Prints ONE JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.queries import REGISTRY  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = [
    "master",                 # full feature table: fused bridge aggregate + dimension joins
    "jn_feature_el",          # minimum slice: bridge -> count pivot -> shares -> attach
    "agg_count_pivot",
    "rat_exploded",
    "agg_indicator_sum",
    "jn_country_lookup",
    "agg_missing_report",
    "ml_dummies",
    "ml_impute_init",
    "ml_split_stratified",
    "ml_threshold_sweep",
    "agg_run_stats",
    "fn_keyword_country",
    "ml_adasyn_hardness",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # warm the JVM (not timed)
    REGISTRY["prj_rename"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        REGISTRY[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
