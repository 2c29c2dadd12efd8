"""Write condensed physical plans of every registered query to PLANS.md.

Usage: python scripts/show_plans.py [sf_dir] [out]
For each query: the operator tree of ``explain("formatted")`` and, per
Parquet scan, the table, pushed and partition filters and the read schema.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.plans.harness import QUERIES  # noqa: E402
from barlake.session import build_session  # noqa: E402


def condensed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    out = [line for line in tree.splitlines() if line.strip() and "Physical Plan" not in line]
    for block in details.split("\n\n"):
        if not block.lstrip().startswith("(") or "Scan parquet" not in block.splitlines()[0]:
            continue
        head = block.splitlines()[0].strip()
        info = {}
        for line in block.splitlines()[1:]:
            key, _, val = line.partition(": ")
            if key in ("Location", "PushedFilters", "PartitionFilters", "ReadSchema"):
                info[key] = val
        loc = re.sub(r".*/", "", info.get("Location", "").rstrip("]"))
        out.append(f"  {head} {loc}: pushed={info.get('PushedFilters', '[]')} "
                   f"partition={info.get('PartitionFilters', '[]')} schema={info.get('ReadSchema', '')}")
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    target = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session()
    parts = ["# Physical plans", "",
             f"`python scripts/show_plans.py {sf_dir}`: operator trees before adaptive",
             "re-planning, with the scan details. Queries that write data while being",
             "built (silver_upsert, silver_merge) show the plan of their final read.", ""]
    for name, q in QUERIES.items():
        parts += [f"## {name}", "", "```", condensed(q(spark, sf_dir)), "```", ""]
    with open(target, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
