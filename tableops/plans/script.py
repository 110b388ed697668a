"""Run several statements in order."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# What may hold a semicolon without ending a statement: comments, raw and plain literals,
# quoted names. Spark reads the statements themselves, comments included.
_COMMENT = r"--[^\n]*|/\*(?:/\*.*?\*/|.)*?\*/"  # a comment may hold one more
_LITERAL = r"""\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`"""
_TOKEN = re.compile(f"(?P<comment>{_COMMENT})|{_LITERAL}|(?P<end>;)", re.DOTALL)


def split_script(script: str) -> list[str]:
    """Cut a script at the semicolons that end statements; blank statements are left out."""
    statements: list[str] = []
    start, last, blank = 0, 0, True
    for token in _TOKEN.finditer(script):
        blank = blank and not script[last : token.start()].strip()
        last = token.end()
        if token["end"]:
            if not blank:
                statements.append(script[start : token.start()].strip())
            start, blank = last, True
        elif not token["comment"]:
            blank = False
    if not blank or script[last:].strip():
        statements.append(script[start:].strip())
    return statements


def run_script(
    spark: SparkSession,
    script: str | Iterable[str],
    args: Mapping[str, Any] | None = None,
) -> dict[str, Any]:
    """Run statements in order and stop at the first that fails.

    Returns ``{'succeeded': True}``, or ``{'succeeded': False, 'error': .., 'sqls': ..}``
    where ``sqls`` holds the failed statement and those after it, so that a run can be
    taken up again with ``run_script(spark, result['sqls'])``.

    A list is taken as one statement per item. ``args`` fills ``:name`` markers. A query
    among the statements is run in full on the executors and its rows are let go.
    """
    statements = split_script(script) if isinstance(script, str) else list(script)
    for done, statement in enumerate(statements):
        try:
            if statement.strip():
                _run(spark.sql(statement, args=dict(args) if args else None))
        except Exception as error:
            return {"succeeded": False, "error": str(error), "sqls": statements[done:]}
    return {"succeeded": True}


def _run(result: DataFrame) -> None:
    # Commands have run by now. A query is lazy until it is asked for its rows.
    if result.columns:
        result.write.format("noop").mode("overwrite").save()
