"""What the writing operators share: counting, spreading, overwriting by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableops.functions.names import quoted


def counted_write(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    metrics: dict[str, Column] | None = None,
    helper_columns: tuple[str, ...] = (),
) -> dict[str, Any]:
    """Run the write and return what it observed: ``rows`` and any further ``metrics``.

    The observation stands last in the plan, after every shuffle: Spark counts each task
    of a job's last stage once, while a retried shuffle task would be counted again.
    """
    observation = Observation()
    aggregates = {"rows": F.count(F.lit(1)), **(metrics or {})}
    observed = df.observe(observation, *[c.alias(n) for n, c in aggregates.items()])
    write(observed.drop(*helper_columns) if helper_columns else observed)
    return observation.get


def rebalanced(df: DataFrame, by: list[str], width: int | None = None) -> DataFrame:
    """Bring together the rows that agree in ``by``; adaptive execution evens out the sizes."""
    columns = [F.col(quoted(c)) for c in by]
    return df.hint("rebalance", *([] if width is None else [width]), *columns)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Within the block an overwrite replaces only the partitions it has rows for.

    The setting is the session's, so no other overwrite should run in the same session
    meanwhile.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)
