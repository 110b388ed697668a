"""Backfills that keep a ledger: cut off and gone on, changed templates, late rows."""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import unquote

import pytest

import tableops.plans.backfill as backfill
from tableops import backfill_daily
from tableops.plans.backfill import day_checksums

START, STOP = "2024-01-01", "2024-01-07"
COUNT = "SELECT kind, count(*) AS n FROM {db}.src WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind"


class Lost(BaseException):
    pass


@pytest.fixture
def tables(spark, db):
    spark.sql(
        f"""CREATE TABLE {db}.src USING parquet AS SELECT id, concat('k', id % 3) AS kind,
            timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) AS ts FROM range(0, 144, 2)"""
    )
    spark.sql(f"CREATE TABLE {db}.t (kind STRING, n BIGINT, day DATE) USING parquet PARTITIONED BY (day)")
    return db


def fill(spark, db, template=COUNT, **more):
    return backfill_daily(
        spark, template.format(db=db), START, STOP, into=f"{db}.t", ledger=f"{db}.ledger", **more
    )


def days(*numbers):
    return [dt.date(2024, 1, n) for n in numbers]


def rows(spark, db):
    spark.catalog.refreshTable(f"{db}.t")
    return sorted((tuple(r) for r in spark.table(f"{db}.t").collect()), key=repr)


def expected(spark, db):
    df = spark.sql(f"SELECT kind, count(*), to_date(ts) FROM {db}.src GROUP BY kind, to_date(ts)")
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stamps(spark, db):
    spark.catalog.refreshTable(f"{db}.t")
    paths = [unquote(f.removeprefix("file://")) for f in spark.table(f"{db}.t").inputFiles()]
    return {p: os.stat(p).st_mtime_ns for p in paths}


def test_run_that_was_cut_off_goes_on(spark, tables, monkeypatch):
    real, seen = backfill.run_script, []

    def lost_at_the_third(session, script, args):
        seen.append(args["start_time"])
        if len(seen) == 3:
            raise Lost
        return real(session, script, args)

    with monkeypatch.context() as patch:
        patch.setattr(backfill, "run_script", lost_at_the_third)
        with pytest.raises(Lost):
            fill(spark, tables)
    before = stamps(spark, tables)
    result = fill(spark, tables)
    assert result == {"succeeded": True, "days": days(3, 4, 5, 6), "skipped": days(1, 2)}
    assert rows(spark, tables) == expected(spark, tables)
    assert before.items() <= stamps(spark, tables).items()
    again = fill(spark, tables)
    assert again == {"succeeded": True, "days": [], "skipped": days(1, 2, 3, 4, 5, 6)}


def test_lost_between_the_day_and_its_record(spark, tables, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(backfill.Ledger, "record", lambda *_: (_ for _ in ()).throw(Lost))
        with pytest.raises(Lost):
            fill(spark, tables)
    assert fill(spark, tables)["days"] == days(1, 2, 3, 4, 5, 6)
    assert rows(spark, tables) == expected(spark, tables)


def test_changed_template_does_all_days_again(spark, tables):
    fill(spark, tables)
    twice = COUNT.replace("count(*)", "2 * count(*)")
    assert fill(spark, tables, twice)["days"] == days(1, 2, 3, 4, 5, 6)
    assert rows(spark, tables) == sorted(((k, 2 * n, d) for k, n, d in expected(spark, tables)), key=repr)
    # back to the first: the last record counts, not any
    assert fill(spark, tables)["days"] == days(1, 2, 3, 4, 5, 6)
    assert rows(spark, tables) == expected(spark, tables)


def test_late_rows_refill_their_days_only(spark, tables):
    source = f"{tables}.src"
    assert fill(spark, tables, source=source)["days"] == days(1, 2, 3, 4, 5, 6)
    assert fill(spark, tables, source=source)["days"] == []
    spark.sql(f"INSERT INTO {source} VALUES (900, 'k9', timestamp_ntz'2024-01-02 03:00:00'), "
              "(901, NULL, timestamp_ntz'2024-01-05 03:00:00'), (901, 'x', timestamp_ntz'2024-02-05 03:00:00')")  # fmt: skip
    before = stamps(spark, tables)
    result = fill(spark, tables, source=source)
    assert result["days"] == days(2, 5)
    inside = [r for r in expected(spark, tables) if r[2] < dt.date(2024, 1, 7)]
    assert rows(spark, tables) == inside
    kept = {p for p in before if not p.split("/day=")[1].startswith(("2024-01-02", "2024-01-05"))}
    after = stamps(spark, tables)
    assert kept and all(after.get(p) == before[p] for p in kept)


def test_failed_days_are_not_recorded(spark, tables):
    bad = COUNT.replace("count(*)", "CAST(if(:start_time = DATE'2024-01-03', 'x', '1') AS BIGINT)")
    result = fill(spark, tables, bad)
    assert not result["succeeded"] and result["failed_day"] == days(3)[0] and result["days"] == days(1, 2)
    again = fill(spark, tables, bad)
    assert again["skipped"] == days(1, 2) and again["days"] == [] and again["failed_day"] == days(3)[0]


def test_scripts_need_a_job_and_jobs_are_apart(spark, db):
    script = f"CREATE TABLE IF NOT EXISTS {db}.log (d DATE) USING parquet; INSERT INTO {db}.log SELECT :start_time"
    with pytest.raises(ValueError, match="name of the job"):
        backfill_daily(spark, script, START, STOP, ledger=f"{db}.ledger")
    for job in ("a", "b", "a"):
        backfill_daily(spark, script, START, "2024-01-03", ledger=f"{db}.ledger", job=job)
    assert spark.table(f"{db}.log").count() == 4


def test_checksums(spark):
    cells = "id long, ts timestamp_ntz, m map<string,int>, s string"
    at = dt.datetime(2024, 1, 1, 5)
    data = [(1, at, {"a": 1}, None), (2, at, None, ""), (2, at, None, "")]

    def sums(rows):
        df = spark.createDataFrame(rows, cells)
        return day_checksums(df, "ts", START, STOP)

    whole = sums(data)
    assert list(whole) == days(1) and whole == sums(data[::-1])
    assert sums(data[:2]) != whole and sums([(1, at, {"a": 1}, ""), *data[1:]]) != whole
    # a value that moves to the next column, and rows outside the range
    assert sums([(1, at, {"a": 2}, None), *data[1:]]) != whole
    assert sums([*data, (5, at + dt.timedelta(days=40), None, None)]) == whole
    assert sums([]) == {}
