"""Clustered rebuilds, and copies that are compared before they are swapped in."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tableops import rebuild_table, save_table
from tableops.operators import rebuild
from tableops.operators.layout import CopyDiffers, checksum, curve


def same_rows(spark, one, other):
    return all(spark.table(a).exceptAll(spark.table(b)).isEmpty() for a, b in [(one, other), (other, one)])


def groups_left(spark, table, bounds):
    """Row groups that a filter on all of these ranges has to read, and all there are."""
    left = total = 0
    for path in spark.table(table).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in bounds}
            total += 1
            left += all(stats[c].min <= hi and stats[c].max >= lo for c, (lo, hi) in bounds.items())
    return left, total


def test_filters_skip_row_groups_of_a_clustered_table(spark, db):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )
    save_table(spark, lines.repartition(16), f"{db}.t")
    keys = lines.agg(F.max("l_partkey"), F.max("l_orderkey")).first()
    bounds = [{"l_partkey": (0, keys[0] // 16)}, {"l_orderkey": (0, keys[1] // 16)}]
    before = [groups_left(spark, f"{db}.t", b) for b in bounds]
    assert rebuild_table(spark, f"{db}.t", partitions=16, cluster_by=["l_partkey", "l_orderkey"])
    after = [groups_left(spark, f"{db}.t", b) for b in bounds]
    assert all(left == total for left, total in before)
    assert all(left <= total / 2 for left, total in after)
    assert same_rows(spark, f"{db}.t", f"{db}.t___old")


def test_clustering_takes_types_nulls_partitions_and_no_rows(spark, db):
    frame = spark.range(500).select(
        F.expr("IF(id % 7 = 0, NULL, id)").alias("n"), F.expr("id % 3").alias("p"),
        F.expr("IF(id % 5 = 0, NULL, concat('ä', id))").alias("s"), F.expr("id % 2 = 0").alias("b"),
        F.expr("date_add(date'2020-01-01', CAST(id AS INT))").alias("d"),
        F.expr("timestamp_seconds(id)").alias("t"), F.expr("CAST(id AS DOUBLE) / 0.3").alias("x"),
        F.expr("map('k', id)").alias("m"),
    )
    save_table(spark, frame, f"{db}.t", partition_by=["p"])
    rebuild_table(spark, f"{db}.t", cluster_by=["n", "s", "b", "d", "t", "x"])
    rows = lambda t: sorted(map(str, spark.table(t).collect()))
    assert rows(f"{db}.t") == rows(f"{db}.t___old")
    save_table(spark, frame.limit(0), f"{db}.e")
    assert rebuild_table(spark, f"{db}.e", cluster_by=["n", "s"]) and spark.table(f"{db}.e").isEmpty()
    for wrong in (["m"], ["n", "N"], list("nsbdtxpn")):
        with pytest.raises(ValueError):
            rebuild_table(spark, f"{db}.e", max_retries=0, cluster_by=wrong)
    assert not spark.catalog.tableExists(f"{db}.e___new")


def test_curve_interleaves_ranks(spark):
    rng = random.Random(0)
    rows = [(rng.randint(0, 10**9), rng.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a long, b double")
    place, seen = curve(df, ["a", "b"])
    assert seen["rows"] == 2000
    for r in df.select("*", place.alias("z")).collect():
        for value, q, shift in ((r["a"], seen["q0"], 0), (r["b"], seen["q1"], 1)):
            rank = sum(b < value for b in q)
            assert rank == sum(((r["z"] >> (2 * bit + shift)) & 1) << bit for bit in range(8))


@pytest.mark.parametrize("spoil", ["lose", "repeat", "change", "to null"])
@pytest.mark.parametrize("cluster_by", [[], ["id"]])
def test_a_copy_that_differs_is_not_swapped_in(spark, db, monkeypatch, spoil, cluster_by):
    save_table(spark, spark.range(100).selectExpr("id", "id AS v"), f"{db}.t")
    spoiled = {
        "lose": lambda df: df.where("id <> 50"),
        "repeat": lambda df: df.unionAll(df.where("id = 50")),
        "change": lambda df: df.selectExpr("id", "IF(id = 50, 51, v) AS v"),
        "to null": lambda df: df.selectExpr("id", "IF(id = 50, NULL, v) AS v"),
    }[spoil]
    step = "_clustered" if cluster_by else "_laid_out"
    real = getattr(rebuild, step)
    monkeypatch.setattr(rebuild, step, lambda df, *more: spoiled(real(df, *more)))
    with pytest.raises(CopyDiffers):
        rebuild_table(spark, f"{db}.t", cluster_by=cluster_by)
    assert spark.table(f"{db}.t").where("id = v").count() == 100
    assert not spark.catalog.tableExists(f"{db}.t___new") and not spark.catalog.tableExists(f"{db}.t___old")


def test_checksum_is_free_of_order_and_not_of_number(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (2, 2)], "a int, b int")
    of = lambda d: tuple(d.agg(*checksum(df.schema)).first())
    assert of(df) == of(df.orderBy(F.desc("a")))
    assert len({of(d) for d in (df, df.limit(0), df.unionAll(df), df.selectExpr("b AS a", "b"))}) == 4


def test_a_true_copy_is_not_scanned_again(spark, db, monkeypatch):
    save_table(spark, spark.range(100), f"{db}.t")
    compared = []
    monkeypatch.setattr(rebuild, "require_same", lambda *a: compared.append(a))
    asked = []
    real = type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *a: (asked.append(1), real(self, *a))[1])
    rebuild_table(spark, f"{db}.t")
    assert compared[0][0] == compared[0][1] and compared[0][0]["rows"] == 100 and not asked
