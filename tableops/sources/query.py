"""SQL text to lazy results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StructType, TimestampNTZType, TimestampType

from tableops.functions.columns import apply_schema
from tableops.functions.names import quoted


def run_sql(
    spark: SparkSession,
    sql: str,
    args: Sequence[Any] | Mapping[str, Any] | None = None,
    limit: int | None = None,
    partitions: int | None = None,
    schema: StructType | str | Mapping[str, str | DataType] | list[str] | None = None,
    format_slots: bool = False,
) -> DataFrame:
    """Run one statement and return its result as a lazy DataFrame.

    ``args`` fills ``?`` markers from a sequence or ``:name`` markers from a mapping.
    With ``format_slots`` the markers in the text are ``%s`` or ``%(name)s`` instead (and
    a literal percent sign is ``%%``), and a list fills its slot as a list in brackets, as
    for ``IN``. The values are bound by Spark, never pasted as text.

    ``limit=None`` returns all rows. ``partitions`` shuffles the result into that many
    tasks; leave it out to let adaptive execution choose.
    """
    if limit is not None and limit < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    if format_slots and args is not None:
        slots, args = _named_slots(args)
        sql %= slots
    df = spark.sql(sql, args=args if args is None or isinstance(args, Mapping) else list(args))
    if limit is not None:
        df = df.limit(limit)
    if partitions is not None:
        df = df.repartition(partitions)
    return df if schema is None else apply_schema(df, schema)


def _named_slots(
    args: Sequence[Any] | Mapping[str, Any],
) -> tuple[tuple[str, ...] | dict[str, str], dict[str, Any]]:
    """The marker text for each slot, and the values by marker name."""
    named = isinstance(args, Mapping)
    texts: dict[Any, str] = {}
    values: dict[str, Any] = {}
    for key, value in args.items() if named else enumerate(args):
        is_list = isinstance(value, (list, tuple))
        markers = []
        for item in value if is_list else [value]:
            name = f"slot{len(values)}"
            values[name] = item
            markers.append(f":{name}")
        texts[key] = f"({', '.join(markers)})" if is_list else markers[0]
    return (texts if named else tuple(texts.values())), values


def run_sql_pandas(
    spark: SparkSession,
    sql: str,
    args: Sequence[Any] | Mapping[str, Any] | None = None,
    limit: int | None = None,
    parse_dates: bool = False,
    columns: list[str] | None = None,
    index_col: str | None = None,
    dtype: Any = None,
    format_slots: bool = False,
):
    """The result as a pandas-on-Spark frame, which stays on the executors.

    Without ``index_col`` the index has increasing, not consecutive, numbers.
    ``parse_dates`` makes date and timestamp columns ``datetime64[ns]``; it is applied
    before ``columns`` renames them.
    """
    from pyspark.pandas import option_context

    df = run_sql(spark, sql, args, limit=limit, format_slots=format_slots)
    if parse_dates:
        temporal = (DateType, TimestampType, TimestampNTZType)
        df = df.select(
            *[
                F.col(quoted(f.name)).cast(TimestampNTZType()).alias(f.name)
                if isinstance(f.dataType, temporal)
                else F.col(quoted(f.name))
                for f in df.schema
            ]
        )
    if columns is not None:
        df = apply_schema(df, columns)
    # The usual default index would count and persist the whole result.
    with option_context("compute.default_index_type", "distributed"):
        frame = df.pandas_api(index_col=index_col)
    return frame if dtype is None else frame.astype(dtype)
