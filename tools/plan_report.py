"""Physical-plan summary of the library's own queries (markdown table).

    python tools/plan_report.py [sf_dir] > plans.md

Per query: shuffles (hash exchanges), broadcasts, partial keep-one limits,
join kinds, scans with their read schema width and pushed filters, and any
Python evaluation or cross-product node (there should be none). The plan is
Spark's initial adaptive plan (before runtime re-planning).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from argent.plans.queries import REGISTRY  # noqa: E402
from argent.session import get_session  # noqa: E402


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarize(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"^\(\d+\) Exchange\s*$", text, re.M)),
        "broadcasts": len(re.findall(r"^\(\d+\) BroadcastExchange", text, re.M)),
        "partial_limits": len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) // 2,
        "smj": tree.count("SortMergeJoin"),
        "bhj": tree.count("BroadcastHashJoin"),
        "scans": tree.count("Scan parquet"),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", text))),
        "python": bool(re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", text)),
        "cross": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | shuffles | broadcasts | partial keep-one limits | SMJ | BHJ | scans | "
          "pushed filters | python | cross |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in REGISTRY.items():
        s = summarize(plan_text(fn(spark, sf_dir)))
        pushed = "; ".join(p[:60] for p in s["pushed"]) or "-"
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['partial_limits']} | "
              f"{s['smj']} | {s['bhj']} | {s['scans']} | {pushed} | "
              f"{'YES' if s['python'] else 'no'} | {'YES' if s['cross'] else 'no'} |")


if __name__ == "__main__":
    main(sys.argv)
