"""What rewrites leave behind and carry over, days without rows, and values held by the caller."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import tableops.operators.rebuild as rebuild
from tableops import backfill_range, daily_slices, rebuild_table, save_table, update_table
from tableops.sources.catalog import describe, table_name


@pytest.fixture
def external(spark, db, tmp_path):
    place = tmp_path / "data"
    spark.range(20).write.option("path", str(place)).saveAsTable(f"{db}.e")
    return f"{db}.e"


def places(tmp_path):
    return sorted(p.name.split("___")[0] for p in tmp_path.iterdir())


def test_external_updates_leave_one_directory_of_their_own(spark, external, tmp_path):
    assert update_table(spark, external, {"id": "0"}, "id > 100") == 0
    assert places(tmp_path) == ["data"]
    assert update_table(spark, external, {"id": "id + 100"}, "id > 9") == 10
    assert update_table(spark, external, {"id": "id + 100"}, "id > 100") == 10
    assert places(tmp_path) == ["data", "data"]
    assert (tmp_path / "data").exists()
    assert spark.table(external).where("id > 200").count() == 10


def test_failing_rebuild_leaves_no_directory(spark, external, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no copy")

    monkeypatch.setattr(rebuild, "_laid_out", broken)
    with pytest.raises(RuntimeError, match="no copy"):
        rebuild_table(spark, external, max_retries=2)
    assert places(tmp_path) == ["data"]
    assert spark.table(external).count() == 20


def test_retype_keeps_buckets_order_and_comments(spark, db):
    name = f"{db}.b"
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT COMMENT 'key', n INT COMMENT 'number', p INT) USING parquet "
        "PARTITIONED BY (p) CLUSTERED BY (id) SORTED BY (id) INTO 4 BUCKETS"
    )
    spark.range(40).selectExpr("id", "CAST(id AS INT)", "CAST(id % 2 AS INT)").write.insertInto(name)
    before = describe(spark, table_name(spark, name))
    assert update_table(spark, name, {"n": "CAST(n AS STRING)"}, retype=True) == 40
    after = describe(spark, table_name(spark, name))
    for key in ("num_buckets", "bucket_columns", "sort_columns", "partition_columns"):
        assert after[key] == before[key]
    comments = {f.name: f.metadata.get("comment") for f in spark.table(name).schema}
    assert comments == {"id": "key", "n": "number", "p": None}
    assert dict(spark.table(name).dtypes)["n"] == "string"


@pytest.mark.parametrize("outside", [False, True])
def test_stale_days_end_empty_under_any_column_name(spark, db, tmp_path, outside):
    name, column = f"{db}.d", "the:Day"
    df = spark.range(3).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias(column))
    writer = df.write.partitionBy(column)
    (writer.option("path", str(tmp_path / "days")) if outside else writer).saveAsTable(name)
    query = "SELECT 9L, DATE '2024-01-02' WHERE :start_time < :stop_time"
    assert backfill_range(spark, query, "2024-01-01", "2024-01-03", name, column.lower()) == 1
    got = sorted(tuple(r) for r in spark.table(name).collect())
    assert got == [(2, dt.date(2024, 1, 3)), (9, dt.date(2024, 1, 2))]


def test_daily_slices_of_a_column_with_a_dot(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 05:00' AS `a.b`")
    got = daily_slices(df, "a.b", "2024-01-01", "2024-01-03", F.count("*").alias("n")).collect()
    assert sorted((str(r.day), r.n) for r in got) == [("2024-01-01", 1), ("2024-01-02", 0)]


def test_bytes_are_text_and_zones_are_not_lost(spark, db):
    save_table(spark, [(b"caf\xc3\xa9",)], f"{db}.s", schema={"s": "varchar"})
    assert spark.table(f"{db}.s").first()[0] == "caf\u00e9"
    zoned = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    with pytest.raises(ValueError, match="no time zone"):
        save_table(spark, [(zoned,)], f"{db}.z", schema={"t": "timestamp"})


def test_a_backfilled_day_reads_its_partition_only(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, _ = contract.days_to_fill(spark, events)
    first, _ = contract.day_bounds(events)
    query = contract.DAY_QUERY.format(source=source, start=":a", stop=":b")
    df = spark.sql(query, {"a": first, "b": first + dt.timedelta(days=1)})
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(on_day" in plan
