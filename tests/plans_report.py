"""Write PLANS.md: physical plans of the key queries, small scale and 'large' scale.

Usage: python -m tests.plans_report [sf_dir] > PLANS.md

"Large" re-plans as if orders, customers and suppliers had outgrown any
broadcast: the size threshold is cut to 3 KB and the order side's row bound
is set to 0.  Relations estimated under 3 KB after column pruning (nation,
region and, at sf0.01, the two-column supplier projection) still broadcast;
at real scale the supplier join would be one more shuffle on the supplier
key.  The zone dimension stays broadcast because it passes its own row bound.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = [
    "monthly_borough_agg",
    "dq_reject_reasons",
    "bronze_incremental",
    "merge_upsert_trips",
    "snapshot_as_of",
    "top_borough_pairs",
]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = []
    for line in buf.getvalue().splitlines():
        line = re.sub(r"#\d+L?", "", line)  # attribute ids are noise here
        line = re.sub(r",? ?\[plan_id=\d+\]", "", line)  # so are exchange plan ids
        lines.append(line if len(line) <= 150 else line[:147] + "...")
    return "\n".join(lines)


def main() -> None:
    from tripmart import catalog
    from tripmart.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    print("# Physical plans\n")
    print(f"Generated by `python -m tests.plans_report {sf_dir}`. Attribute ids removed, long lines cut.\n")
    print(__doc__.split("\n\n", 2)[2].strip() + "\n")
    from tripmart.sources import tables

    for title, conf in (("Small tables (sf0.01)", None), ("Large-table shape", "3000")):
        if conf:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
            tables.ORDER_ZONE_BROADCAST_ROWS = 0
        print(f"## {title}\n")
        for key in KEYS:
            df = catalog.queries()[key](spark, sf_dir)
            print(f"### {key}\n\n```\n{plan_text(df)}\n```\n")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


if __name__ == "__main__":
    main()
