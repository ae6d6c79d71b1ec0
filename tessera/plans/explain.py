"""Write the physical plans of registered queries (``python -m tessera.plans.explain``).

For each query: the operator tree of ``explain("formatted")`` plus the scan
details (pushed filters, read schema), so join strategies, exchanges and
pruning can be reviewed without running the query.
"""
from __future__ import annotations

import contextlib
import io
import sys

from tessera.plans.queries import REGISTRY
from tessera.session import local_session

DEFAULT = ["master", "jn_feature_el", "rat_exploded", "agg_missing_report", "ml_threshold_sweep",
           "ml_adasyn_hardness", "chk_unmatched_keys", "agg_collect_list"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [ln for ln in details.splitlines()
            if ln.startswith("(") and "Scan" in ln or ln.startswith(("PushedFilters", "ReadSchema"))]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main(sf_dir: str, names: list[str], out: str) -> None:
    spark = local_session(8, shuffle_partitions=16)
    with open(out, "w") as fh:
        fh.write(f"# Physical plans ({sf_dir}, static plan before AQE re-optimisation)\n\n")
        for n in names:
            fh.write(f"## {n}\n\n```\n{plan_text(REGISTRY[n](spark, sf_dir))}\n```\n\n")


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    main(sf, sys.argv[2].split(",") if len(sys.argv) > 2 else DEFAULT,
         sys.argv[3] if len(sys.argv) > 3 else "PLANS.md")
