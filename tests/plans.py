"""Physical-plan checks shared by the tests and the command line."""

import re
import sys

from sparkmart.plans.registry import all_queries
from sparkmart.session import local_session


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def findings(plan: str) -> list[str]:
    """Operators that do not scale: nested loops, Python workers, windows over one partition."""
    out = []
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsIn", "MapInPandas", "MapInArrow"):
        if bad in plan:
            out.append(f"{bad} x{plan.count(bad)}")
    for line in plan.splitlines():
        if re.search(r"\bWindow(GroupLimit)? \[.*\], \[[^\[\]]*\b(ASC|DESC)\b", line) and re.search(r"\], \[[^\]]*(ASC|DESC)", line):
            spec = re.search(r"windowspecdefinition\(([^()]*)", line)
            if spec and re.match(r"\s*[\w#`]+ (ASC|DESC)", spec.group(1)):
                out.append("global window: " + spec.group(1)[:60])
    return out


if __name__ == "__main__":
    spark = local_session()
    for key, q in all_queries().items():
        if len(sys.argv) > 1 and not any(key.startswith(a) for a in sys.argv[1:]):
            continue
        found = findings(physical(q(spark, "/root/testdata/sf0.001")))
        if found:
            print(key, found, flush=True)
