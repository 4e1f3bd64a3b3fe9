"""Physical-plan summary of the library's registered queries (writes PLANS.md).

Usage: python tests/plan_report.py [sf_dir] > PLANS.md

Counts come from the final adaptive plans of all SQL executions of a query, as Spark's
event log has them: those of eager steps (written intermediates, bound checks) and that of
the result. FPGrowth's own jobs run on RDDs and have no SQL plan; their input and output do.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.queries import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402

SHOWN = ("Exchange", "ReusedExchange", "BroadcastExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
         "BroadcastNestedLoopJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window")


def nodes(plan: dict) -> list[str]:
    name = re.sub(r" \(\d+\)$", "", plan["nodeName"]).strip()
    return [name, *(n for c in plan["children"] for n in nodes(c))]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log = tempfile.mkdtemp(prefix="plan-report-", dir="/tmp")
    os.environ["PYSPARK_SUBMIT_ARGS"] = (f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file://{log} "
                                         "--conf spark.eventLog.compress=false --conf spark.eventLog.rolling.enabled=false pyspark-shell")
    spark = local_session(8)
    for name, fn in QUERIES.items():
        spark.sparkContext.setJobDescription(name)
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    plans, of = {}, {}
    for path in glob.glob(f"{log}/*"):
        with open(path) as f:
            for line in f:
                if "sparkPlanInfo" in line:
                    e = json.loads(line)
                    plans[e["executionId"]] = e["sparkPlanInfo"]  # the last is the one that ran
                    if "description" in e:
                        of[e["executionId"]] = e["description"]
    counts, runs, python = defaultdict(Counter), Counter(), set()
    for k, plan in plans.items():
        found = nodes(plan)
        runs[of.get(k)] += 1
        counts[of.get(k)].update(n for n in found if n in SHOWN)
        if any(re.search("Python|Pandas|Arrow", n) for n in found):
            python.add(of.get(k))
    print("# Plan summary\n")
    about = next(p for p in (__doc__ or "").split("\n\n") if p.startswith("Counts"))
    print(f"Generated by `python tests/plan_report.py {sf_dir}`. " + about.strip().replace("\n", " ") + "\n")
    print("| Query | SQL executions | " + " | ".join(SHOWN) + " | Python |")
    print("| --- |" + " --- |" * (len(SHOWN) + 2))
    for name in QUERIES:
        print(f"| `{name}` | {runs[name]} | " + " | ".join(str(counts[name][n]) for n in SHOWN)
              + f" | {'yes' if name in python else 'no'} |")


if __name__ == "__main__":
    main()
