"""Processes that end in the middle of a swap, replace, update or rebuild."""

from __future__ import annotations

import pytest

from tableops import finish_update, rebuild_table, recover_table, save_table, swap_tables, update_table
from tableops.sources.catalog import PATCH_SUFFIX, describe, table_name

CHANGING = ("ALTER", "MSCK", "DROP")


class Lost(BaseException):
    """No handler of the library sees this: the process is gone."""


def lost_before(monkeypatch, spark, at):
    """The process ends before its `at`-th statement that changes the catalog."""
    kind, seen = type(spark), []
    real = kind.sql

    def sql(self, text, *args, **more):
        if text.split()[0] in CHANGING:
            seen.append(text)
            if len(seen) == at:
                raise Lost(text)
        return real(self, text, *args, **more)

    monkeypatch.setattr(kind, "sql", sql)
    return seen


def swap(spark, db):
    swap_tables(spark, f"{db}.new", f"{db}.t")


def replace(spark, db):
    save_table(spark, spark.range(100, 105).selectExpr("id", "id % 2 AS day"), f"{db}.t", "replace")


def update(spark, db):
    update_table(spark, f"{db}.t", {"id": "id + 100"})


def update_part(spark, db):
    finish_update(spark, f"{db}.t")
    update_table(spark, f"{db}.t", {"id": "id + 100"}, "id < 100", only_partitions="day = 1")


def rebuild(spark, db):
    rebuild_table(spark, f"{db}.t")


OLD = {(i, i % 2) for i in range(6)}
CASES = {
    swap: {(i, i % 2) for i in range(100, 105)},
    replace: {(i, i % 2) for i in range(100, 105)},
    update: {(i + 100, i % 2) for i in range(6)},
    update_part: {(i + 100 if i % 2 else i, i % 2) for i in range(6)},
    rebuild: OLD,
}


def rows(spark, name):
    spark.catalog.refreshTable(name)
    return {tuple(r) for r in spark.table(name).collect()}


@pytest.mark.parametrize("work", CASES, ids=lambda f: f.__name__)
@pytest.mark.parametrize("partitioned", [True, False])
def test_lost_at_every_step(spark, monkeypatch, work, partitioned):
    if work is update_part and not partitioned:
        return
    new, step = CASES[work], 0
    while True:
        step += 1
        db = f"lost_{work.__name__}_{int(partitioned)}_{step}"
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        spark.sql(f"CREATE DATABASE {db}")
        for name, first, stop in (("t", 0, 6), ("new", 100, 105)):
            made = spark.range(first, stop).selectExpr("id", "id % 2 AS day").coalesce(1)
            (made.write.partitionBy("day") if partitioned else made.write).saveAsTable(f"{db}.{name}")
        with monkeypatch.context() as patch:
            lost_before(patch, spark, step)
            try:
                work(spark, db)
                ended = True
            except Lost:
                ended = False
        if not ended:
            # what is there now is repaired to old or new rows, and a second call changes nothing
            recover_table(spark, f"{db}.t")
            pending = spark.catalog.tableExists(f"{db}.t{PATCH_SUFFIX}")
            if pending:
                finish_update(spark, f"{db}.t")
            found = rows(spark, f"{db}.t")
            assert found in (OLD, new), (step, found)
            assert recover_table(spark, f"{db}.t") is None
            assert not [k for k in describe(spark, table_name(spark, f"{db}.t")).get("table_properties") or {}
                        if k.startswith("tableops")]
            if found == OLD or work is rebuild:
                work(spark, db)
        assert rows(spark, f"{db}.t") == new
        if work is rebuild:
            assert rows(spark, f"{db}.t___old") == OLD
        spark.sql(f"DROP DATABASE {db} CASCADE")
        if ended:
            break
    assert step > 2


def test_next_call_repairs_without_being_asked(spark, db, monkeypatch):
    """Lost after the second rename, before its partitions are recovered: the table reads empty."""
    for name, n in (("t", 20), ("new", 30)):
        spark.range(n).selectExpr("id", "id % 3 AS day").write.partitionBy("day").saveAsTable(f"{db}.{name}")
    with monkeypatch.context() as patch:
        seen = lost_before(patch, spark, 9)
        with pytest.raises(Lost):
            swap_tables(spark, f"{db}.new", f"{db}.t")
    assert seen[-1].startswith("MSCK") and "___old" not in seen[-1]
    assert rebuild_table(spark, f"{db}.t")
    assert spark.table(f"{db}.t").count() == spark.table(f"{db}.t___old").count() == 30


def test_recover_table_leaves_others_alone(spark, db):
    assert recover_table(spark, f"{db}.nothing") is None
    spark.range(3).write.saveAsTable(f"{db}.t")
    spark.range(2).write.saveAsTable(f"{db}.t___old")
    assert recover_table(spark, f"{db}.t") is None
    assert spark.table(f"{db}.t___old").count() == 2
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS x")
    assert recover_table(spark, f"{db}.v") is None
    # a backup that no swap of this library left is refused, not touched
    spark.range(2).write.saveAsTable(f"{db}.u___old")
    with pytest.raises(ValueError, match="interrupted"):
        update_table(spark, f"{db}.u", {"id": "1"})


def test_swap_ended_by_asking_again(spark, db, monkeypatch):
    spark.range(3).write.saveAsTable(f"{db}.secret_tokens")
    spark.range(5).write.saveAsTable(f"{db}.new")
    with monkeypatch.context() as patch:
        lost_before(patch, spark, 4)
        with pytest.raises(Lost):
            swap_tables(spark, f"{db}.new", f"{db}.secret_tokens", keep_backup=True)
    assert not spark.catalog.tableExists(f"{db}.secret_tokens")
    assert swap_tables(spark, f"{db}.new", f"{db}.secret_tokens", keep_backup=True)
    assert spark.table(f"{db}.secret_tokens").count() == 5
    assert spark.table(f"{db}.secret_tokens___old").count() == 3
