"""Write PLANS.md: for every registered query, the shuffles, joins and top-k operators
of its final (adaptive) physical plan at the given scale.

Usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens.plans.catalog import QUERIES  # noqa: E402
from visitlens.session import get_spark  # noqa: E402

PATTERNS = [
    ("hash shuffle", r"Exchange hashpartitioning"),
    ("range shuffle", r"Exchange rangepartitioning"),
    ("round-robin (small input)", r"Exchange RoundRobinPartitioning"),
    ("single-partition shuffle", r"Exchange SinglePartition"),
    ("broadcast hash join", r"BroadcastHashJoin"),
    ("sort-merge join", r"SortMergeJoin"),
    ("shuffled hash join", r"ShuffledHashJoin"),
    ("partial aggregate", r"(?:Hash|ObjectHash|SortAggregate)Aggregate\(keys=\[[^\]]*\], functions=\[partial_"),
    ("WindowGroupLimit", r"WindowGroupLimit .*Partial"),
    ("window", r"\bWindow \["),
    ("TakeOrderedAndProject", r"TakeOrderedAndProject"),
]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]")
    lines = ["# Physical plan summary", "",
             f"Final adaptive plans at `{sf}` on local[8] (`python tools/plan_summary.py`). Counts of "
             "shuffles, join strategies and top-k operators per query. The round-robin shuffle "
             "appears only because each test file is a single parquet row group "
             "(`sources/fixtures.table`); the library's readers have no such step. Broadcast joins of "
             "user / product dimensions here are AQE's run-time choice for small measured sides.",
             "", "| Query | Plan operators |", "| --- | --- |"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan, so that what follows is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "isFinalPlan=false" in plan:
            raise RuntimeError(f"{name}: not the executed plan")
        plan = plan.split("== Initial Plan ==")[0]
        counts = Counter()
        for label, pat in PATTERNS:
            n = len(re.findall(pat, plan))
            if n:
                counts[label] = n
        summary = ", ".join(f"{k} x{v}" if v > 1 else k for k, v in counts.items()) or "scan + project only"
        lines.append(f"| `{name}` | {summary} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
