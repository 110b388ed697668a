"""Rewrite only the partitions whose files are too many or too big."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import and_
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from tableops.functions.names import quoted
from tableops.operators.rebuild import rebuild_table
from tableops.operators.swap import recover_table
from tableops.operators.update import finish_update, partitions_are
from tableops.sources.catalog import (
    BACKUP_SUFFIX,
    PATCH_SUFFIX,
    UPDATED_SUFFIX,
    TableName,
    create_like,
    drop_table,
    rename_table,
    require_table,
    table_name,
)

# Fixed value: the directory name of the NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: A partition is left alone while it has at most this many times the files it needs.
SLACK = 1.5
#: Partitions that are rewritten by one job.
AT_ONCE = 1000


def compact_table(spark: SparkSession, name: str, file_bytes: int = 96 << 20) -> int:
    """Bring the files of a table near ``file_bytes``; return the number of partitions rewritten.

    A partition needs its bytes over ``file_bytes`` files, rounded up. It is rewritten when it has
    over 1.5 times as many, or a file of over 1.5 times the size; all others keep their files, so
    a second call does nothing. Sizes come from a listing; no data is read to find out. The rows of a partition are dealt to as many tasks as it needs files, so that a big
    partition is the work of many; partitions are overwritten from a finished copy, as by
    ``update_table``, and an interruption is ended by ``finish_update``. That copy is read by splits of
    ``spark.sql.files.maxPartitionBytes``, so ``file_bytes`` should stay well below it. A table without
    partitions is rebuilt and swapped.
    """
    target = table_name(spark, name)
    recover_table(spark, target)
    info = require_table(spark, target)
    parts = info.get("partition_columns") or []
    layout = StructType([spark.table(str(target)).schema[c] for c in parts])
    ill = _ill_sized(spark, info["location"], file_bytes).where(
        F.size(F.split("folder", "/")) == len(parts) if parts else F.col("folder") == ""
    )
    done = 0
    if not parts:
        found = ill.first()
        if found is not None:
            rebuild_table(spark, str(target), partitions=found["needed"])
            drop_table(spark, target.with_suffix(BACKUP_SUFFIX))
        return int(found is not None)
    # a row for each partition that is rewritten
    rows = ill.orderBy("folder").collect()
    for at in range(0, len(rows), AT_ONCE):
        some = {tuple(_values(r["folder"])): r["needed"] for r in rows[at : at + AT_ONCE]}
        _rewrite(spark, target, info, layout, some)
        done += len(some)
    return done


def _ill_sized(spark: SparkSession, location: str, file_bytes: int) -> DataFrame:
    """folder, below the table's own, and the files it needs, where it has too many or too big ones.

    The files' contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    # a location may be written with one slash after its scheme, or with three
    root = location.split(":", 1)[-1].strip("/")
    path = F.substring_index(F.col("path"), f"/{root}/", -1)
    folder = F.regexp_replace(path, "/?[^/]*$", "")
    sizes = files.select(folder.alias("folder"), "length").groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("most")
    )
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int")
    return sizes.withColumn("needed", needed).where(
        (F.col("files") > SLACK * F.col("needed")) | (F.col("most") > SLACK * file_bytes)
    )


def _values(folder: str) -> list[str | None]:
    texts = [unquote(step.split("=", 1)[1]) for step in folder.split("/")]
    return [None if t == NULL_PARTITION else t for t in texts]


def _rewrite(
    spark: SparkSession, target: TableName, info: dict[str, Any], layout: StructType, needed: dict[tuple, int]
) -> None:
    table = spark.table(str(target))
    # the texts of directories as values of the columns' types; a partition's files are numbered
    # from `first` on
    names = [f"___{i}" for i in range(len(layout))]
    cast = [F.col(n).cast(f.dataType).alias(n) for n, f in zip(names, layout)]
    texts = StructType().add("___files", IntegerType()).add("___first", IntegerType())
    for n in names:
        texts = texts.add(n, StringType())
    firsts = accumulate(needed.values(), initial=0)
    given = spark.createDataFrame(
        [(n, first, *v) for (v, n), first in zip(needed.items(), firsts)], texts
    ).select("___files", "___first", *cast)
    scope = partitions_are(layout.names, [Row(*r[2:]) for r in given.collect()])

    # deal each partition's rows to as many tasks as it needs files; `given` has AT_ONCE rows at most
    same = reduce(and_, [F.col(quoted(f.name)).eqNullSafe(F.col(n)) for n, f in zip(names, layout)])
    place = F.col("___first") + F.pmod(F.monotonically_increasing_id(), F.col("___files")).cast("int")
    dealt = table.where(scope).join(F.broadcast(given), same).withColumn("___place", place)
    dealt = dealt.repartitionById(sum(needed.values()), F.col("___place")).select(
        *[F.col(quoted(c)) for c in table.columns]
    )
    stage = target.with_suffix(UPDATED_SUFFIX)
    create_like(spark, stage, target, info)
    dealt.write.insertInto(str(stage))
    rename_table(spark, stage, target.with_suffix(PATCH_SUFFIX))
    finish_update(spark, target)
