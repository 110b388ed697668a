"""Failures in the middle of renames, and texts and type names that were once misread."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

import tableops.sources.catalog as catalog
from tableops import cast_temporal, rebuild_table, run_sql_pandas, swap_tables
from tableops.functions.types import spark_type
from tableops.operators.rebuild import retriable


def partitioned(spark, name, n):
    spark.range(n).selectExpr("id", "id % 3 AS day").write.partitionBy("day").saveAsTable(name)


def failing(monkeypatch, at):
    """Lets the repair of partitions raise the `at`-th time, once."""
    real, calls = catalog.repair_partitions, []

    def repair(spark, name):
        calls.append(name)
        if len(calls) == at:
            raise RuntimeError("no repair")
        real(spark, name)

    monkeypatch.setattr(catalog, "repair_partitions", repair)


@pytest.mark.parametrize("at", [1, 2])
def test_failed_repair_undoes_the_swap(spark, db, monkeypatch, at):
    partitioned(spark, f"{db}.old", 20)
    partitioned(spark, f"{db}.new", 30)
    failing(monkeypatch, at)
    with pytest.raises(RuntimeError, match="no repair"):
        swap_tables(spark, f"{db}.new", f"{db}.old")
    assert spark.table(f"{db}.old").count() == 20
    assert spark.table(f"{db}.new").count() == 30
    assert swap_tables(spark, f"{db}.new", f"{db}.old")
    assert spark.table(f"{db}.old").count() == 30


@pytest.mark.parametrize("at", [1, 2])
def test_failed_repair_in_a_rebuild_loses_nothing(spark, db, monkeypatch, at):
    partitioned(spark, f"{db}.t", 20)
    failing(monkeypatch, at)
    with pytest.raises(RuntimeError, match="no repair"):
        rebuild_table(spark, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 20
    assert rebuild_table(spark, f"{db}.t")
    assert spark.table(f"{db}.t").count() == spark.table(f"{db}.t___old").count() == 20


@pytest.mark.parametrize("lenient", [False, True])
def test_formats_keep_clock_times(spark, lenient):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [("10/03/2024 02:30", "10/03/2024")] + [("no", "no")] * lenient
        df = spark.createDataFrame(rows, "at string, day string")
        out = cast_temporal(
            df, {"at": "timestamp", "day": "date"}, lenient=lenient,
            formats={"at": "dd/MM/yyyy HH:mm", "day": "dd/MM/yyyy"},
        )
        assert out.dtypes == [("at", "timestamp_ntz"), ("day", "date")]
        got = [tuple(map(str, r)) for r in out.collect()]
        assert got == [("2024-03-10 02:30:00", "2024-03-10")] + [("None", "None")] * lenient
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_type_names():
    assert spark_type("array") == T.ArrayType(T.StringType())
    assert spark_type("map(varchar, array)").valueType == T.ArrayType(T.StringType())
    assert spark_type("MAP") == T.MapType(T.StringType(), T.StringType())
    kind = spark_type("struct<real:integer,UserId:bigint,`a b`:varchar(3),in:struct<Timestamp:timestamp>>")
    assert kind.fieldNames() == ["real", "UserId", "a b", "in"]
    assert [f.dataType for f in kind][:3] == [T.IntegerType(), T.LongType(), T.StringType()]
    assert kind["in"].dataType == T.StructType([T.StructField("Timestamp", T.TimestampNTZType())])


def test_retries_end_at_limits(spark, db, monkeypatch):
    partitioned(spark, f"{db}.t", 5)
    import tableops.operators.rebuild as rebuild

    for text, tries in (("quota Exceeded", 1), ("Too many queued queries", 1), ("lost node", 3)):
        calls = []

        def copy(*_, text=text, calls=calls):
            calls.append(1)
            raise RuntimeError(text)

        monkeypatch.setattr(rebuild, "_laid_out", copy)
        with pytest.raises(RuntimeError, match=text):
            rebuild_table(spark, f"{db}.t", max_retries=2)
        assert len(calls) == tries and retriable(RuntimeError(text)) == (tries > 1)
        assert not spark.catalog.tableExists(f"{db}.t___new")
    assert spark.table(f"{db}.t").count() == 5


def test_pandas_result_persists_nothing(spark):
    frame = run_sql_pandas(spark, "SELECT id FROM range(5)")
    plan = frame._internal.spark_frame._jdf.queryExecution().toString()
    assert "AttachDistributedSequence" not in plan and len(frame) == 5
