"""Write PLANS.md: the final (post-AQE) physical plans of the library's queries.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md

Each query runs once (collected; meant for the small scale) so AQE settles its
plan; the summary line counts shuffles, broadcasts, sorts, windows, aggregates
and codegen stages, and shows whether filters reached the scan. Queries that
write tables on the way also list the plans of those writes, taken from Spark's
event log: how often each shape ran, and its operators.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.queries import QUERIES  # noqa: E402
from ledgerline.session import get_session  # noqa: E402


def shape(node: dict, depth: int = 0) -> list[str]:
    """The operators of a logged plan, one line each, without the wrappers."""
    name = node["nodeName"].split(" (")[0]
    skip = re.match("WholeStageCodegen|InputAdapter|AdaptiveSparkPlan|ShuffleQueryStage|BroadcastQueryStage|ResultQueryStage|ColumnarToRow|Execute|WriteFiles|CommandResult", name)
    said = node["simpleString"]
    detail = ""
    if name.startswith("Exchange"):
        detail = " " + re.sub(r"#\d+L?|, \[plan_id.*|Exchange ", "", said)[:60]
    elif name.startswith("Scan"):
        where = re.search(r"Location: \w+(\(\d+ paths\))?\[([^\]]*)", said)
        detail = " " + re.sub(r"[0-9a-f]{12,}", "*", re.sub(r"file:/\S*?(ledgerline|testdata/[^/]+)/", "", where[2]))[:60] if where else ""
    lines = [] if skip else ["  " * depth + name + detail]
    for child in node["children"]:
        lines += shape(child, depth + (not skip))
    return lines


def writes(log_dir: str, since: dict[str, int]) -> Counter:
    """Plans of the writes logged since the positions in ``since``."""
    last: dict[int, dict] = {}
    for name in os.listdir(log_dir):
        with open(f"{log_dir}/{name}", errors="replace") as log:
            log.seek(since.get(name, 0))
            for line in log:
                try:
                    event = json.loads(line)
                except ValueError:
                    continue
                if "sparkPlanInfo" in event:
                    last[event["executionId"]] = event["sparkPlanInfo"]
            since[name] = log.tell()
    return Counter("\n".join(shape(plan)) for plan in last.values() if "InsertIntoHadoopFsRelationCommand" in json.dumps(plan))


def summary(plan: str) -> str:
    counts = {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)),
        "single-partition shuffles": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial group limits": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "hash aggregates": plan.count("HashAggregate("),
        "sort aggregates": plan.count("SortAggregate("),
        "codegen stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "scans": plan.count("FileScan parquet"),
        "scans with pushed filters": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
    }
    return ", ".join(f"{k}: {v}" for k, v in counts.items() if v)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="ll-plans-")
    spark = get_session(**{"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    since: dict[str, int] = {}
    print("# Physical plans\n")
    print(f"Final plans after adaptive execution, one run per query at `{os.path.basename(sf_dir)}` on `local[*]`, "
          "generated by `tools/explain_plans.py`. Under queries that write tables on the way stand the operators of "
          "those writes as well, with how often each ran.\n")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()  # run this DataFrame's own execution so AQE finalizes its plan (small at sf0.01)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("+- == Initial Plan ==")[0]  # keep the final plan only
        plan = re.sub(r"file:/\S+?/(\w+\.parquet)", r"\1", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        plan = "\n".join(line[:400] for line in plan.strip().split("\n"))
        print(f"## {name}\n\n{summary(plan)}\n\n```\n{plan}\n```\n")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for text, times in writes(log_dir, since).most_common():
            print(f"Written {times} time{'s' * (times > 1)}:\n\n```\n{text}\n```\n")


if __name__ == "__main__":
    main()
