"""Physical plans as text."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def rows_by_operator(df: DataFrame) -> list[int]:
    """Rows that each operator gave when the whole result was computed."""
    return _metrics(df, "numOutputRows")


def files_read(df: DataFrame) -> int:
    """Files that scans were given when the whole result was computed."""
    return sum(_metrics(df, "numFiles"))


def _metrics(df: DataFrame, name: str) -> list[int]:
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    found, todo = [], [execution.executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        metric = node.metrics().get(name)
        if metric.isDefined():
            found.append(metric.get().value())
        if node.getClass().getSimpleName() == "InMemoryTableScanExec":
            continue
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found
