"""Summarise the physical plan of every registered query: python tests/plan_summary.py [sf_dir] > PLANS.md

Each query's own plan is executed once, so the adaptive plan is final, then its
operators are counted: shuffles, join strategies, aggregates, windows, top-k,
Python nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [("Exchange", r"\bExchange (hash|range|Single|RoundRobin|SinglePartition)"),
         ("BroadcastExchange", r"BroadcastExchange"), ("BHJ", r"BroadcastHashJoin"), ("SMJ", r"SortMergeJoin"),
         ("SHJ", r"ShuffledHashJoin"), ("BNLJ", r"BroadcastNestedLoopJoin"), ("Cartesian", r"CartesianProduct"),
         ("HashAgg", r"\bHashAggregate"), ("SortAgg", r"SortAggregate"), ("ObjHashAgg", r"ObjectHashAggregate"),
         ("Window", r"\bWindow \["), ("GroupLimit", r"WindowGroupLimit"), ("TopK", r"TakeOrderedAndProject"),
         ("Expand", r"\bExpand\b"), ("Generate", r"\bGenerate\b"), ("Python", r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)"),
         ("Reused", r"ReusedExchange")]
SKIP_PREFIX = ("stream_",)


def main():
    from venuelens.session import checkpoint_dir, get_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    checkpoint_dir(spark)
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Counts of plan nodes per query (generated by `tests/plan_summary.py`). Streaming queries are "
          "micro-batch jobs and are not listed.\n")
    print("| query | " + " | ".join(n for n, _ in NODES) + " |")
    print("| --- |" + " --- |" * len(NODES))
    for name, fn in E.registry.queries().items():
        if name.startswith(SKIP_PREFIX):
            continue
        df = fn(spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()      # runs this very plan, so what is printed is what ran
        p = df._jdf.queryExecution().executedPlan().toString()
        p = p.split("== Initial Plan ==")[0]          # count the final adaptive plan only
        counts = [len(re.findall(rx, p)) for _, rx in NODES]
        print(f"| {name} | " + " | ".join(str(c) if c else "" for c in counts) + " |")


if __name__ == "__main__":
    main()
