"""Catalog tables: names, metadata, and the DDL the table operators are made of."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tableops.functions.columns import result_schema
from tableops.functions.names import quoted, sql_text

_PART = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")
_STAGE_SUFFIX = re.compile(r"___[0-9a-f]{32}$")
_REDACTED = "*********(redacted)"

# Suffixes of the tables that operators put beside a table: the backup of a
# swap or rebuild, the stage of a rebuild or replace, the stage of an update, and the
# finished partitions of an update.
BACKUP_SUFFIX = "___old"
NEW_SUFFIX = "___new"
UPDATED_SUFFIX = "___updated"
PATCH_SUFFIX = "___patch"

# Properties that say what is under way. A table whose partitions may still point
# at its former directory has the first; one that is being swapped out has the second.
MOVING = "tableops.moving"
SWAP = "tableops.swap"


@dataclass(frozen=True)
class TableName:
    """``database.table`` in the session catalog; ``str()`` is its quoted form."""

    database: str
    table: str

    def __str__(self) -> str:
        return f"{quoted(self.database)}.{quoted(self.table)}"

    def with_suffix(self, suffix: str) -> TableName:
        return replace(self, table=self.table + suffix)


def table_name(spark: SparkSession, name: str | TableName) -> TableName:
    """Resolve a one- to three-part name; the catalog part may only be the session catalog."""
    if isinstance(name, TableName):
        return name
    parts = [
        (tick.replace("``", "`") if tick else plain.strip()) for tick, plain in _PART.findall(name)
    ]
    if len(parts) == 3 and parts[0].lower() == "spark_catalog":
        parts = parts[1:]
    if len(parts) == 1:
        parts = [spark.catalog.currentDatabase(), *parts]
    if len(parts) != 2:
        raise ValueError(f"Expected a name like db.table, got {name!r}")
    return TableName(*parts)


def table_exists(spark: SparkSession, name: TableName) -> bool:
    return spark.catalog.tableExists(str(name))


def describe(spark: SparkSession, name: TableName) -> dict[str, Any]:
    """The catalog's own description of a table. Reads metadata only."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])


def table_schema(spark: SparkSession, name: str) -> DataFrame | None:
    """Position, name and type of a table's columns, or None if there is no such table."""
    target = table_name(spark, name)
    if not table_exists(spark, target):
        return None
    return result_schema(spark.table(str(target)))


def require_table(spark: SparkSession, name: TableName) -> dict[str, Any]:
    """Describe a table that is about to be changed; a view or a missing table is an error."""
    if not table_exists(spark, name):
        backup = name.with_suffix(BACKUP_SUFFIX)
        lost = table_exists(spark, backup)
        hint = f", but {backup} does: was a swap interrupted?" if lost else ""
        raise ValueError(f"Table {name} does not exist{hint}")
    refuse_pending(spark, name)
    info = describe(spark, name)
    if info.get("type") == "VIEW":
        raise ValueError(f"{name} is a view")
    return info


def refuse_pending(spark: SparkSession, name: TableName) -> None:
    """Finishing an update overwrites partitions, so nothing may change them before."""
    patch = name.with_suffix(PATCH_SUFFIX)
    if table_exists(spark, patch):
        raise ValueError(
            f"An update of {name} was interrupted with its rows in {patch}: "
            "call finish_update first"
        )


def stage_location(info: dict[str, Any]) -> str | None:
    """A new location beside an external table's own, or None for a managed table."""
    if info.get("type") != "EXTERNAL":
        return None
    return f"{_STAGE_SUFFIX.sub('', info['location'].rstrip('/'))}___{uuid.uuid4().hex}"


def create_like(
    spark: SparkSession, stage: TableName, source: TableName, info: dict[str, Any]
) -> None:
    """An empty table with the source's columns, layout, format, comment and properties."""
    drop_table(spark, stage)
    location = stage_location(info)
    at = "" if location is None else f" LOCATION {sql_text(location)}"
    spark.sql(f"CREATE TABLE {stage} LIKE {source}{at}")
    carry_description(spark, stage, info)


def carry_description(spark: SparkSession, stage: TableName, info: dict[str, Any]) -> None:
    if info.get("comment"):
        spark.sql(f"COMMENT ON TABLE {stage} IS {sql_text(info['comment'])}")
    properties = {
        k: v
        for k, v in (info.get("table_properties") or {}).items()
        if v != _REDACTED and k not in (MOVING, SWAP)
    }
    if properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ({pairs})")


def drop_table(spark: SparkSession, name: TableName) -> None:
    """Drop a table; of an external one also its directory, if a rewrite has made that."""
    made = None
    if table_exists(spark, name):
        info = describe(spark, name)
        location = (info.get("location") or "").rstrip("/")
        if info.get("type") == "EXTERNAL" and _STAGE_SUFFIX.search(location):
            made = location
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if made is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(made)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def rename_table(spark: SparkSession, source: TableName, target: TableName) -> None:
    """Rename, and point the partitions of a managed table at the directory's new path.

    Both or neither: if the partitions can't be recovered, the table gets its name back, and
    with it the directory to which its partitions still point. If the process is lost on the
    way, the table is left with a property that makes `settle` recover them.
    """
    info = describe(spark, source)
    moves = info.get("type") == "MANAGED" and bool(info.get("partition_columns"))
    if moves:
        set_note(spark, source, MOVING, str(target))
    spark.sql(f"ALTER TABLE {source} RENAME TO {target}")
    if moves:
        # A catalog may keep the old partition paths, and the table then reads as empty.
        try:
            repair_partitions(spark, target)
        except Exception:
            spark.sql(f"ALTER TABLE {target} RENAME TO {source}")
            drop_note(spark, source, MOVING)
            raise
        drop_note(spark, target, MOVING)


def settle(spark: SparkSession, name: TableName) -> None:
    """Recover the partitions of a table whose rename was never ended."""
    if note(describe(spark, name), MOVING) is not None:
        repair_partitions(spark, name)
        drop_note(spark, name, MOVING)


def note(info: dict[str, Any], key: str) -> Any:
    text = (info.get("table_properties") or {}).get(key)
    return None if text is None else json.loads(bytes.fromhex(text))


def set_note(spark: SparkSession, name: TableName, key: str, value: Any) -> None:
    """Written as hex, for Spark blanks out properties whose text has words like token in it."""
    text = json.dumps(value).encode().hex()
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({sql_text(key)} = {sql_text(text)})")


def drop_note(spark: SparkSession, name: TableName, key: str) -> None:
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({sql_text(key)})")


def repair_partitions(spark: SparkSession, name: TableName) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
