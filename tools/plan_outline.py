"""Write PLANS.md: a compact physical-plan outline of every registered query.

    python tools/plan_outline.py [sf_dir]

Queries that write files while being built are run once (their writes go to
the shared scratch folder); the outline shows the plan of the returned
DataFrame. Only operator lines that matter for scale are kept: exchanges,
aggregates, windows and limits, joins, generators, scans (with pushed filters).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

KEEP = ("Exchange", "Aggregate", "Window", "Join", "Generate", "TakeOrdered", "Scan", "Limit", "Union",
        "Expand", "Sort ", "Subquery")


def outline(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        s = line.rstrip()
        body = s.lstrip(" :+-")
        if not any(k in body for k in KEEP):
            continue
        indent = len(s) - len(s.lstrip(" :+-"))
        body = re.sub(r"#\d+L?", "", body)
        body = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", lambda m: "Location: " +
                      m.group(1).rsplit("/", 1)[-1], body)
        body = re.sub(r", \[plan_id=\d+\]", "", body)
        out.append(" " * indent + (body[:220] + " …" if len(body) > 220 else body))
    return out


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from layerkit.plans.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="layerkit-plans-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Physical plan outlines", "",
             f"Generated by `python tools/plan_outline.py {sf_dir}` (local[8], 16 shuffle partitions, AQE initial",
             "plans). Each block lists exchanges, aggregates, windows/limits, joins, generators and scans, top",
             "(output) to bottom (input); `partial_`/`Partial` operators run before the shuffle.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + outline(plan) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
