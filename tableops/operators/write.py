"""Write data to a table: create, append, replace."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tableops.functions.columns import NULL_TOKENS, null_token_column
from tableops.functions.names import quoted
from tableops.functions.types import struct_from, struct_of
from tableops.operators.counted import counted_write, rebalanced
from tableops.operators.swap import recover_table, swap_tables
from tableops.sources.catalog import (
    NEW_SUFFIX,
    TableName,
    create_like,
    drop_table,
    require_table,
    stage_location,
    table_exists,
    table_name,
)
from tableops.sources.frames import as_frame, is_frame

MODES = ("fail", "append", "replace")


def save_table(
    spark: SparkSession,
    data: Any,
    name: str,
    if_exists: str = "fail",
    schema: StructType | str | Mapping[str, str | DataType] | None = None,
    match: str = "position",
    expressions: Mapping[str, str] | None = None,
    null_tokens: Iterable[str] = NULL_TOKENS,
    keep_structure: bool = True,
    partition_by: Iterable[str] = (),
    rebalance: bool = True,
) -> int:
    """Write ``data`` to a table on the executors and return the number of rows written.

    ``data`` is a DataFrame (Spark, pandas-on-Spark or pandas), a list of rows, or a list
    of DataFrames, which are put one after the other with duplicates kept.

    ``if_exists``: ``fail``; ``append`` (creates a missing table); ``replace`` (the new
    table is written beside the old one and then swapped in, so a failure keeps the old).

    Columns are cast to ``schema``, else to the existing table's types (``append``, and
    ``replace`` with ``keep_structure``). ``match`` pairs them by ``position`` or ``name``.
    ``expressions`` gives the SQL of a column over the input's columns. ``null_tokens`` in
    the other columns become NULL.

    ``partition_by`` lays out a table that is created, or replaced under a new structure.
    ``rebalance`` brings the rows of a partition together, splitting big ones, before a
    partitioned write; without it every task writes a file to every partition it meets.
    """
    mode = if_exists.lower()
    if mode not in MODES:
        raise ValueError(f"if_exists must be one of {', '.join(MODES)}: {if_exists!r}")
    if match not in ("position", "name"):
        raise ValueError(f"match must be position or name: {match!r}")
    target = table_name(spark, name)
    recover_table(spark, target)
    exists = table_exists(spark, target)
    if exists and mode == "fail":
        raise ValueError(f"Table {target} already exists")

    given = None if schema is None else struct_of(schema)
    keeps = exists and (mode == "append" or (keep_structure and given is None))
    wanted = given
    if wanted is None and keeps:
        wanted = spark.table(str(target)).schema
    partition_by = list(partition_by)
    if keeps and partition_by:
        raise ValueError(f"Table {target} keeps its own partitioning")

    expressions = {k.lower(): v for k, v in (expressions or {}).items()}
    tokens = tuple(null_tokens)
    row_schema = None
    if wanted is not None:
        row_schema = StructType([f for f in wanted if f.name.lower() not in expressions])
    if not is_frame(data):
        data = list(data)
    many = not is_frame(data) and data and all(map(is_frame, data))
    parts = data if many else [data]
    frames = [
        _shaped(as_frame(spark, part, row_schema), wanted, match, expressions, tokens)
        for part in parts
    ]
    df = reduce(DataFrame.unionAll, frames)

    if mode == "append" and exists:
        info = require_table(spark, target)
        df = _fitted(spark, df, target)
        df = _spread(df, info.get("partition_columns") or [], rebalance)
        return counted_write(df, lambda out: out.write.insertInto(str(target)))["rows"]
    if not exists:
        return _create(df, target, partition_by, rebalance)

    info = require_table(spark, target)
    stage = target.with_suffix(NEW_SUFFIX)
    if keeps:
        create_like(spark, stage, target, info)
        df = _spread(df, info.get("partition_columns") or [], rebalance)
        written = counted_write(df, lambda out: out.write.insertInto(str(stage)))["rows"]
    else:
        drop_table(spark, stage)
        written = _create(df, stage, partition_by, rebalance, stage_location(info))
    swap_tables(spark, stage, target)
    return written


def bulk_insert(
    spark: SparkSession, name: str, rows: Any, types: Iterable[str] | None = None
) -> int:
    """Append by position to a table that exists; without types, values are taken as text."""
    target = table_name(spark, name)
    recover_table(spark, target)
    require_table(spark, target)
    names = spark.table(str(target)).columns
    schema = None if types is None else struct_from(names, types)
    return save_table(spark, rows, target, if_exists="append", schema=schema)


def create_from_data(
    spark: SparkSession,
    name: str,
    *parts: Any,
    schema: StructType | str | Mapping[str, str | DataType],
    drop_if_exists: bool = False,
) -> int:
    """Create a table from one or more parts, every row of every part kept."""
    schema = struct_of(schema)
    mode = "replace" if drop_if_exists else "fail"
    frames = [as_frame(spark, part, schema) for part in parts]
    return save_table(spark, frames, name, mode, schema, keep_structure=False)


def _shaped(
    df: DataFrame,
    wanted: StructType | None,
    match: str,
    expressions: Mapping[str, str],
    tokens: tuple[str, ...],
) -> DataFrame:
    """NULL tokens, expression columns and casts in one projection over the input row.

    Expression columns go by name, the others by ``match``.
    """
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"Repeated column name in {', '.join(df.columns)}")
    computed = {name: F.expr(text) for name, text in expressions.items()}
    plain = {
        f.name.lower(): null_token_column(f.name, f.dataType, tokens)
        for f in df.schema
        if f.name.lower() not in computed
    }
    if wanted is None:
        kept = [
            computed[n].alias(c) if n in computed else plain[n] for n, c in zip(names, df.columns)
        ]
        added = [c.alias(n) for n, c in computed.items() if n not in names]
        return df.select(*kept, *added)

    fields = [f.name.lower() for f in wanted]
    unknown = [n for n in computed if n not in fields]
    if unknown:
        raise ValueError(f"Expressions for no column of the table: {unknown}")
    stored = [n for n in fields if n not in computed]
    if match == "name" and sorted(stored) != sorted(plain):
        raise ValueError(f"The table has columns {stored}, the data has {list(plain)}")
    if len(stored) != len(plain):
        raise ValueError(f"The data has {len(plain)} columns, the table {len(stored)}")
    source = plain if match == "name" else dict(zip(stored, plain.values()))
    return df.select(
        *[
            (computed[n] if n in computed else source[n]).cast(f.dataType).alias(f.name)
            for n, f in zip(fields, wanted)
        ]
    )


def _fitted(spark: SparkSession, df: DataFrame, target: TableName) -> DataFrame:
    """Cast to the table's own types, column by position."""
    schema = spark.table(str(target)).schema
    if len(schema) != len(df.columns):
        raise ValueError(f"The data has {len(df.columns)} columns, {target} has {len(schema)}")
    return df.select(
        *[F.col(quoted(c)).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema)]
    )


def _spread(df: DataFrame, partition_by: list[str], rebalance: bool) -> DataFrame:
    return rebalanced(df, partition_by) if partition_by and rebalance else df


def _create(
    df: DataFrame,
    target: TableName,
    partition_by: list[str],
    rebalance: bool,
    location: str | None = None,
) -> int:
    def write(out: DataFrame) -> None:
        writer = out.write.mode("errorifexists")
        if location is not None:
            writer = writer.option("path", location)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(str(target))

    return counted_write(_spread(df, partition_by, rebalance), write)["rows"]
