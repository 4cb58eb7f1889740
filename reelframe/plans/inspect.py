"""Physical-plan checks used by tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF")


def physical_plan(df: DataFrame) -> str:
    """The final physical plan as text (adaptive plans show their initial form)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    """What ``df.explain("formatted")`` prints, as a string."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def python_nodes(df: DataFrame) -> list[str]:
    plan = physical_plan(df)
    return [n for n in PYTHON_NODES if n in plan]


def count_nodes(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)
