"""Conditional update by rewrite: tables on plain files take no UPDATE statement."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableops.functions.names import quoted
from tableops.operators.counted import counted_write, dynamic_overwrite, rebalanced
from tableops.operators.swap import recover_table, swap_tables
from tableops.sources.catalog import (
    PATCH_SUFFIX,
    UPDATED_SUFFIX,
    carry_description,
    create_like,
    drop_table,
    rename_table,
    require_table,
    settle,
    stage_location,
    table_exists,
    table_name,
)

_HIT = "___hit"
#: Partitions with updated rows that are rewritten one by one; their values come to the driver.
HIT_PARTITIONS = 1000


def update_table(
    spark: SparkSession,
    name: str,
    sets: Mapping[str, str],
    where: str | None = None,
    retype: bool = False,
    only_partitions: str | None = None,
) -> int:
    """Set columns to SQL expressions where a predicate holds; return the rows updated.

    All expressions see the old row. Without ``where`` every row is updated. A row for
    which the predicate is NULL stays as it is. Values are cast to the column's type;
    ``retype`` (only without ``where``) takes the expression's type instead.

    The table is read once, in one job, into a table beside it, which is then swapped in.
    There is no shuffle, unless a partition column is set, so that rows change partition,
    or Spark joins a subquery of the predicate.

    Of a partitioned table only partitions with rows to update are written. They are found first,
    by a scan of the predicate's and partition columns alone, with the predicate pushed down; the
    table is rewritten whole if they are over half of all, or over HIT_PARTITIONS, or if the
    predicate is not deterministic. ``only_partitions`` is a deterministic predicate over
    partition columns alone: other partitions are then neither read nor written nor updated, and
    those it names are all written.
    """
    target = table_name(spark, name)
    recover_table(spark, target)
    info = require_table(spark, target)
    table = spark.table(str(target))
    parts = info.get("partition_columns") or []
    changes = _checked_sets(table.schema, sets)
    if retype and where is not None:
        raise ValueError("retype changes every row, so it takes no predicate")

    hit = F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))
    moves_rows = any(c in changes for c in parts)
    if only_partitions is not None:
        if moves_rows or retype:
            raise ValueError("only_partitions can neither set partition columns nor retype")
        if not parts:
            raise ValueError(f"{target} has no partition columns")
        # A frame of the partition columns alone refuses a predicate over any other column.
        layout = StructType([table.schema[c] for c in parts])
        spark.createDataFrame([], layout).where(only_partitions)
        table = table.where(only_partitions)

    elif where is not None and parts and not moves_rows:
        _updated(table, changes, hit, retype)  # a mistake in an expression shows without hits too
        found = _hit_partitions(table.where(F.expr(where).cast("boolean")), parts)
        if found == []:
            return 0
        if found is not None and 2 * len(found) <= spark.sql(f"SHOW PARTITIONS {target}").count():
            table, only_partitions = table.where(partitions_are(parts, found)), where

    updated = _updated(table, changes, hit, retype)
    if moves_rows:
        updated = rebalanced(updated, parts)
    stage = target.with_suffix(UPDATED_SUFFIX)
    drop_table(spark, stage)
    if not retype:
        create_like(spark, stage, target, info)

    def write(out: DataFrame) -> None:
        if not retype:
            out.write.insertInto(str(stage))
            return
        location = stage_location(info)
        writer = out.write.format(info["provider"]).mode("errorifexists")
        if location is not None:
            writer = writer.option("path", location)
        if info.get("num_buckets"):
            writer = writer.bucketBy(int(info["num_buckets"]), list(info["bucket_columns"]))
            if info.get("sort_columns"):
                writer = writer.sortBy(list(info["sort_columns"]))
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(str(stage))
        carry_description(spark, stage, info)

    hits = counted_write(updated, write, {"hits": F.count_if(F.col(_HIT))}, (_HIT,))["hits"]
    if hits == 0:
        drop_table(spark, stage)
    elif only_partitions is None:
        swap_tables(spark, stage, target)
    else:
        rename_table(spark, stage, target.with_suffix(PATCH_SUFFIX))
        finish_update(spark, target)
    return hits


def finish_update(spark: SparkSession, name: str) -> bool:
    """Put the partitions of a complete patch in place; False if there is none.

    ``update_table(only_partitions=..)`` ends with this. It overwrites whole partitions
    from the patch, so after an interruption it can simply be called again.
    """
    target = table_name(spark, name)
    patch = target.with_suffix(PATCH_SUFFIX)
    if not table_exists(spark, patch):
        return False
    settle(spark, patch)
    settle(spark, target)
    with dynamic_overwrite(spark):
        spark.table(str(patch)).write.insertInto(str(target), overwrite=True)
    spark.catalog.refreshTable(str(target))
    drop_table(spark, patch)
    return True


def _hit_partitions(rows: DataFrame, parts: list[str]) -> list[Row] | None:
    """The partitions of the rows; None if there are too many or another scan may find others."""
    if not rows._jdf.queryExecution().analyzed().deterministic():
        return None
    found = rows.select(*map(quoted, parts)).distinct().take(HIT_PARTITIONS + 1)
    return found if len(found) <= HIT_PARTITIONS else None


def partitions_are(parts: list[str], values: list[Row]) -> Column:
    """A predicate on the partition columns, which prunes when the scan is planned."""
    any_of = [
        reduce(and_, [F.col(quoted(c)).eqNullSafe(F.lit(v)) for c, v in zip(parts, row)])
        for row in values
    ]
    return reduce(or_, any_of)


def _checked_sets(schema: StructType, sets: Mapping[str, str]) -> dict[str, str]:
    columns = {f.name.lower(): f.name for f in schema}
    changes: dict[str, str] = {}
    for name, text in sets.items():
        column = columns.get(name.lower())
        if column is None:
            raise ValueError(f"No column {name!r} in the table")
        if column in changes:
            raise ValueError(f"Column {column!r} is set twice")
        if not text or not text.strip():
            raise ValueError(f"Empty expression for column {name!r}")
        changes[column] = text
    if not changes:
        raise ValueError("Nothing to set")
    return changes


def _updated(
    table: DataFrame, changes: Mapping[str, str], hit: Column, retype: bool
) -> DataFrame:
    def column(name: str) -> Column:
        old = F.col(quoted(name))
        if name not in changes:
            return old
        new = F.expr(changes[name])
        if retype:
            comment = table.schema[name].metadata.get("comment")
            return new.alias(name, metadata={} if comment is None else {"comment": comment})
        new = new.cast(table.schema[name].dataType)
        return F.when(F.col(_HIT), new).otherwise(old).alias(name)

    # The predicate has its own projection, so that it is evaluated once per row, and a
    # subquery in it joined once, however many columns are set.
    return table.withColumn(_HIT, hit).select(*map(column, table.columns), _HIT)
