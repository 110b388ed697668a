"""Put one table in the place of another."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tableops.sources.catalog import (
    BACKUP_SUFFIX,
    SWAP,
    TableName,
    describe,
    drop_note,
    drop_table,
    note,
    refuse_pending,
    rename_table,
    set_note,
    settle,
    table_exists,
    table_name,
)


def swap_tables(
    spark: SparkSession,
    new_table: str,
    old_table: str,
    ignore_if_not_exists: bool = False,
    keep_backup: bool = False,
) -> bool:
    """Rename ``new_table`` to ``old_table``; the old one is dropped or kept as ``___old``.

    A backup from an earlier swap is dropped first. The swap is two renames and so not
    atomic: between them the name is missing. A rename that can't recover its partitions is
    undone, and if the second fails the first is undone too.

    Before the first rename the old table is given a property that names the new one. If the
    process is lost at any point, ``recover_table`` reads it and ends or undoes the swap; every
    function that changes the table calls that first. Old and new rows are kept until then.
    """
    new, old = table_name(spark, new_table), table_name(spark, old_table)
    if new == old:
        raise ValueError(f"Cannot swap {old} with itself")
    if recover_table(spark, old) == new and not table_exists(spark, new):
        return True
    if not table_exists(spark, new):
        raise ValueError(f"Table {new} does not exist")
    had_old = table_exists(spark, old)
    if not had_old and not ignore_if_not_exists:
        raise ValueError(f"Table {old} does not exist")
    refuse_pending(spark, old)
    settle(spark, new)
    backup = old.with_suffix(BACKUP_SUFFIX)
    if had_old:
        drop_table(spark, backup)
        set_note(spark, old, SWAP, [new.database, new.table, keep_backup])
        try:
            rename_table(spark, old, backup)
        except Exception:
            drop_note(spark, old, SWAP)
            raise
    try:
        rename_table(spark, new, old)
    except Exception:
        if had_old and not table_exists(spark, old):
            rename_table(spark, backup, old)
            drop_note(spark, old, SWAP)
        raise
    if had_old:
        _end(spark, backup, keep_backup)
    elif not keep_backup:
        drop_table(spark, backup)
    return True


def recover_table(spark: SparkSession, name: str | TableName) -> TableName | None:
    """End or undo a swap or rename of the table that was cut off; else do nothing.

    A swap whose first rename took place is ended, one before it is undone. Partitions that may
    point at a former directory are recovered before anything reads the table, and the old rows
    are dropped only when the new ones are in place. It can itself be cut off and called again.

    Returns the name the new rows had, if a swap was ended.
    """
    target = table_name(spark, name)
    backup = target.with_suffix(BACKUP_SUFFIX)
    here = table_exists(spark, target)
    if here:
        info = describe(spark, target)
        if info.get("type") == "VIEW":
            return None
        settle(spark, target)
        if note(info, SWAP) is not None:
            drop_note(spark, target, SWAP)
    if not table_exists(spark, backup):
        return None
    intent = note(describe(spark, backup), SWAP)
    if intent is None:
        return None
    settle(spark, backup)
    database, table, keep_backup = intent
    new = TableName(database, table)
    if not here:
        if not table_exists(spark, new):
            rename_table(spark, backup, target)
            drop_note(spark, target, SWAP)
            return None
        settle(spark, new)
        rename_table(spark, new, target)
    _end(spark, backup, keep_backup)
    return new


def _end(spark: SparkSession, backup: TableName, keep: bool) -> None:
    if keep:
        drop_note(spark, backup, SWAP)
    else:
        drop_table(spark, backup)
