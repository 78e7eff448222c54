"""Plan inspection helpers: what a query will run, read from its physical plan."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text (the final plan if the DataFrame already ran)."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_summary(df: DataFrame) -> dict:
    """Operator counts that matter at scale."""
    p = physical_plan(df)
    return {
        "broadcast_hash_joins": p.count("BroadcastHashJoin"),
        "sort_merge_joins": p.count("SortMergeJoin"),
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange RoundRobinPartitioning|Exchange SinglePartition", p)),
        "scans": p.count("FileScan parquet") + p.count("Scan parquet"),
        "python": sum(p.count(k) for k in ("BatchEvalPython", "ArrowEvalPython")),
        "forbidden": [k for k in FORBIDDEN if k in p],
    }
