"""What the plans of the operators are checked with."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    nodes = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")
    return [n for n in nodes if n in executed_plan(df)]
