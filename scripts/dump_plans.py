"""Write PLANS.md: the final (post-AQE) physical plan of every query of the library.

usage: python scripts/dump_plans.py [sf_dir]

Each query is planned twice: as it is, and with automatic broadcasting off,
which is what larger inputs get.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.plans import catalog  # noqa: E402
from marquee.session import local_session  # noqa: E402

WIDTH = 170


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    out = ["# Physical plans", "",
           f"Final adaptive plans of every query of the library on `{os.path.basename(sf_dir)}`, "
           "`local[8]`, 16 shuffle partitions (generated by `scripts/dump_plans.py`). "
           "`FileScan parquet` over `marquee-staging/topk-input-…` marks a materialized input; "
           "`FileScan parquet` lines show the pruned `ReadSchema`.", ""]
    for title, threshold in (("as they are", None), ("without automatic broadcasts", "-1")):
        out += [f"# {title.capitalize()}", ""]
        if threshold:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        for name, fn in catalog.queries().items():
            df = fn(spark, sf_dir)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
            lines = [ln if len(ln) <= WIDTH else ln[:WIDTH] + " …" for ln in plan.splitlines()]
            out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
