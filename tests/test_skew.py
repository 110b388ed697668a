"""One key with a third of all rows: results stay whole, and no task gets the whole group."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tableops import backfill_range, daily_slices, save_table, update_table


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables, with a third of the orders moved to one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    source = "/root/testdata/sf0.001"
    for name in ("customer", "nation"):
        shutil.copy(f"{source}/{name}.parquet", folder / f"{name}.parquet")
    orders = spark.read.parquet(f"{source}/orders.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", hot.cast("bigint")).write.parquet(str(folder / "orders.parquet"))
    return str(folder)


def test_window_by_month_equals_the_plain_window(spark, skewed):
    numbered = contract.sql_window(spark, skewed)
    plain = spark.sql(
        """SELECT o_custkey, o_orderkey, CAST(row_number() OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rn FROM orders"""
    )
    assert plain.where("o_custkey = 7").count() >= 500
    assert numbered.exceptAll(plain).count() == plain.exceptAll(numbered).count() == 0


def test_join_after_counting_equals_the_plain_join(spark, skewed):
    counted = contract.sql_join(spark, skewed)
    plain = spark.sql(
        """SELECT n_name, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )
    assert counted.exceptAll(plain).count() == plain.exceptAll(counted).count() == 0


@pytest.fixture
def hot_day(spark, db):
    frame = spark.range(0, 60_000, 1, 8).selectExpr(
        "id",
        "uuid() AS u",
        "IF(id % 3 = 0, DATE'2024-01-10', date_add(DATE'2024-01-01', CAST(id % 20 AS INT))) AS day",
    )
    save_table(spark, frame, f"{db}.src")
    return spark.table(f"{db}.src")


def test_hot_partition_is_written_by_several_tasks(spark, db, hot_day):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128KB")
    try:
        assert save_table(spark, hot_day, f"{db}.t", partition_by=["day"]) == 60_000
    finally:
        spark.conf.set(key, before)
    files = spark.table(f"{db}.t").inputFiles()
    assert sum("2024-01-10" in f for f in files) > 1
    assert spark.table(f"{db}.t").exceptAll(hot_day).count() == 0
    assert update_table(spark, f"{db}.t", {"day": "DATE'2024-02-01'"}, "id % 3 = 0") == 20_000
    assert spark.table(f"{db}.t").where("day = DATE'2024-02-01'").count() == 20_000
    assert spark.table(f"{db}.t").count() == 60_000


def test_hot_day_in_slices_and_range(spark, db, hot_day):
    sliced = daily_slices(
        hot_day, "day", "2024-01-01", "2024-01-21",
        F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("users"),
    )
    expected = hot_day.groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("u").alias("users"))
    assert sliced.exceptAll(expected).count() == expected.exceptAll(sliced).count() == 0
    spark.sql(f"CREATE TABLE {db}.rows (id BIGINT, u STRING, day DATE) USING parquet PARTITIONED BY (day)")
    query = f"SELECT * FROM {db}.src WHERE day >= :start_time AND day < :stop_time"
    assert backfill_range(spark, query, "2024-01-01", "2024-01-21", f"{db}.rows") == 60_000
    assert spark.table(f"{db}.rows").exceptAll(hot_day).count() == 0
