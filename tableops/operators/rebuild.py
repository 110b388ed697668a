"""Rewrite a table's files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableops.functions.names import quoted
from tableops.operators.counted import rebalanced
from tableops.operators.layout import CopyDiffers, checksum, curve, require_same
from tableops.operators.swap import recover_table, swap_tables
from tableops.sources.catalog import (
    NEW_SUFFIX,
    TableName,
    create_like,
    drop_table,
    require_table,
    table_name,
)


# Texts of errors that another try would only meet again.
LASTING = ("exceeded", "too many queued queries")


def retriable(error: Exception) -> bool:
    """False for statements at fault, and for limits and full queues."""
    text = str(error).lower()
    return not isinstance(error, AnalysisException) and not any(x in text for x in LASTING)


def rebuild_table(
    spark: SparkSession,
    name: str,
    partitions: int | None = None,
    max_retries: int = 5,
    shuffle: bool = True,
    retry_if: Callable[[Exception], bool] = retriable,
    cluster_by: Iterable[str] = (),
) -> bool:
    """Copy a table into fresh files, swap the copy in and keep the old one as ``___old``.

    Files come out at the session's advisory size: adaptive execution joins small shuffle
    partitions and splits big ones, hot table partitions included. ``partitions`` fixes
    the task count of an unpartitioned copy, and is the shuffle width of a partitioned one.
    ``shuffle=False`` copies as the scan packs its files, which costs no shuffle and is
    enough where they are not very small.

    ``cluster_by`` sorts the copy along a space-filling curve through these columns, within each
    table partition, so that files and row groups hold narrow ranges of all of them and filters on
    any skip most. That is a scan for quantiles, one for the sort's ranges, and the copy.

    Number and checksum of the rows are observed where the copy reads and where it writes. If
    they differ the swap doesn't happen, the copy is dropped and ``CopyDiffers`` raised.

    A failed copy is repeated up to ``max_retries`` times as long as ``retry_if`` holds for
    the error; by default not where the statement is at fault or a limit is exceeded. What
    was copied is dropped when giving up.
    """
    target = table_name(spark, name)
    recover_table(spark, target)
    info = require_table(spark, target)
    stage = target.with_suffix(NEW_SUFFIX)
    by = info.get("partition_columns") or []
    cluster_by = list(cluster_by)
    failures = 0
    while True:
        try:
            create_like(spark, stage, target, info)
            _copy(spark, target, stage, by, partitions, shuffle, cluster_by)
            break
        except CopyDiffers:
            drop_table(spark, stage)
            raise
        except Exception as error:
            failures += 1
            if failures > max_retries or not retry_if(error):
                drop_table(spark, stage)
                raise
    return swap_tables(spark, stage, target, keep_backup=True)


def _copy(
    spark: SparkSession,
    target: TableName,
    stage: TableName,
    by: list[str],
    partitions: int | None,
    shuffle: bool,
    cluster_by: list[str],
) -> None:
    table = spark.table(str(target))
    sums = checksum(table.schema)
    read, wrote = Observation(), Observation()
    if cluster_by:
        place, expected = curve(table, cluster_by)
        copy = _clustered(table, [*(F.col(quoted(c)) for c in by), place], partitions)
    else:
        expected = None
        seen = table.observe(read, *sums)
        copy = _laid_out(seen, by, partitions) if shuffle else seen
    copy.observe(wrote, *sums).write.insertInto(str(stage))
    if expected is None:
        expected = read.get
        if expected != wrote.get and shuffle:
            # tasks before a shuffle that ran again are observed again: ask the table itself
            expected = spark.table(str(target)).agg(*sums).first().asDict()
    require_same(expected, wrote.get, str(target))


def _clustered(table: DataFrame, order: list, partitions: int | None) -> DataFrame:
    if partitions is None:
        return table.repartitionByRange(*order).sortWithinPartitions(*order)
    return table.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def _laid_out(table: DataFrame, by: list[str], partitions: int | None) -> DataFrame:
    if partitions is not None and not by:
        return table.repartition(partitions)
    return rebalanced(table, by, partitions)
