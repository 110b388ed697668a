"""Updates of partitioned tables write only the partitions that hold updated rows."""

from __future__ import annotations

import os
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException

import tableops.operators.update as update
from tableops import save_table, update_table


def files(spark, name):
    spark.catalog.refreshTable(name)
    return {f: os.stat(unquote(f.removeprefix("file://"))).st_mtime_ns for f in spark.table(name).inputFiles()}


def touched(before, after):
    """Partitions with another file than before."""
    return {f.split("/")[-2] for f in set(before) ^ set(after)}


@pytest.fixture
def daily(spark, db):
    df = spark.range(100).selectExpr("id", "id % 10 AS day", "CASE WHEN id > 50 THEN 'a' END AS kind")
    save_table(spark, df, f"{db}.t", partition_by=["day"])
    return f"{db}.t"


def test_one_hit_writes_one_partition(spark, daily):
    before = files(spark, daily)
    assert update_table(spark, daily, {"kind": "'x'"}, "id IN (23, 43)") == 2
    assert touched(before, files(spark, daily)) == {"day=3"}
    assert {r.id for r in spark.table(daily).where("kind = 'x'").collect()} == {23, 43}
    assert spark.table(daily).count() == 100
    assert sorted(r.id for r in spark.table(daily).collect()) == list(range(100))


def test_no_hit_writes_nothing(spark, daily):
    before = files(spark, daily)
    assert update_table(spark, daily, {"kind": "'x'"}, "id > 1000") == 0
    assert update_table(spark, daily, {"kind": "'x'"}, "NULL") == 0
    assert files(spark, daily) == before


def test_mistakes_show_without_hits(spark, daily):
    with pytest.raises(AnalysisException):
        update_table(spark, daily, {"kind": "no_such_column"}, "id > 1000")


def test_null_predicates_and_many_hits(spark, daily):
    # NULL = 'a' is neither true nor false; every partition is hit, so the table is swapped
    before = files(spark, daily)
    assert update_table(spark, daily, {"kind": "'x'"}, "kind = 'a'") == 49
    assert len(touched(before, files(spark, daily))) == 10
    assert spark.table(daily).where("kind = 'x'").count() == 49


def test_null_partitions_and_several_columns(spark, db):
    df = spark.range(60).selectExpr(
        "id", "CASE WHEN id % 5 > 0 THEN DATE'2024-01-01' + CAST(id % 5 AS INT) END AS day",
        "CASE WHEN id % 3 > 0 THEN concat('k=', id % 3) END AS `the kind`", "id * 1.5D AS v",
    )
    save_table(spark, df, f"{db}.t", partition_by=["day", "the kind"])
    before = files(spark, f"{db}.t")
    assert update_table(spark, f"{db}.t", {"v": "-1"}, "id IN (0, 15, 1)") == 3
    changed = set(before) ^ set(files(spark, f"{db}.t"))
    assert len({os.path.dirname(f) for f in changed}) == 2
    got = {r.id: r.v for r in spark.table(f"{db}.t").collect()}
    assert got == {i: -1.0 if i in (0, 15, 1) else i * 1.5 for i in range(60)}


def test_random_predicates_rewrite_the_table(spark, daily):
    n = update_table(spark, daily, {"kind": "'x'"}, "rand() < 0.5")
    assert spark.table(daily).where("kind = 'x'").count() == n


def test_too_many_partitions_rewrite_the_table(spark, daily, monkeypatch):
    monkeypatch.setattr(update, "HIT_PARTITIONS", 1)
    before = files(spark, daily)
    assert update_table(spark, daily, {"kind": "'x'"}, "id IN (23, 44)") == 2
    assert len(touched(before, files(spark, daily))) == 10


def test_subquery_predicates(spark, db, daily):
    spark.createDataFrame([(7,), (17,), (None,)], "k long").createOrReplaceTempView("hit_keys")
    before = files(spark, daily)
    assert update_table(spark, daily, {"kind": "'x'"}, "id IN (SELECT k FROM hit_keys WHERE k IS NOT NULL)") == 2
    assert touched(before, files(spark, daily)) == {"day=7"}


def test_the_search_reads_few_columns(spark, daily, monkeypatch):
    from tests.plans import executed_plan

    plans = []
    real = update._hit_partitions

    def seen(rows, parts):
        plans.append(executed_plan(rows.select(*parts)))
        return real(rows, parts)

    monkeypatch.setattr(update, "_hit_partitions", seen)
    update_table(spark, daily, {"kind": "'x'"}, "id = 23")
    (plan,) = plans
    assert "ReadSchema: struct<id:bigint>" in plan
    assert "EqualTo(id,23)" in plan
