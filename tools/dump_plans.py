"""Write docs/PLANS.md: the physical plan of every registered query outside llm/.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from martworks.plans.registry import QUERIES  # noqa: E402
from martworks.session import get_session  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # keep the operator tree; drop per-node attribute ids and long scan details
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"Location: [^,]+\[file:[^\]]*\]", "Location: ...", plan)
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    return plan.rstrip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    out = ["# Physical plans", "",
           f"Initial physical plans (before AQE re-planning) of every registered query outside llm/, read at `{sf_dir}`.",
           "Operators computed on the driver before the plan (quantile bounds, watermarks) appear as literals.", ""]
    for name, fn in QUERIES.items():
        out += [f"## {name}", "", "```", tree(fn(spark, sf_dir)), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
