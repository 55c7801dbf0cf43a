"""Plan inspection: what a Spark user reads from ``explain()``, as values.

Used by the tests and the plan report to assert pushdown, pruning and join
strategy instead of eyeballing ``explain("formatted")``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, final: bool = False) -> str:
    """The executed plan as text. ``final=True`` runs the query first so the
    adaptive plan shows the strategies AQE chose at run time."""
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))


def read_schemas(df: DataFrame) -> list[str]:
    """``ReadSchema`` of every file scan (column pruning)."""
    return re.findall(r"ReadSchema: (struct<[^ ]*>)", physical_plan(df))


def join_strategies(df: DataFrame, final: bool = False) -> list[str]:
    return re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)",
                      physical_plan(df, final))


def shuffle_count(df: DataFrame) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                          physical_plan(df)))
