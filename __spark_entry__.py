"""

Each query runs the library over the given tables. Those that write do so in a database
of their own, made anew on every call.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops import (
    apply_schema,
    backfill_daily,
    backfill_range,
    bulk_insert,
    cast_temporal,
    compact_table,
    create_from_data,
    daily_slices,
    normalize_nulls,
    rebuild_table,
    recover_table,
    result_schema,
    run_script,
    run_sql,
    run_sql_pandas,
    save_table,
    swap_tables,
    table_schema,
    update_table,
)
from tableops.sources.catalog import BACKUP_SUFFIX, SWAP, TableName, rename_table, set_note

ENTRY_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Events counted per day and type, filled in one day at a time."""
    return backfill_daily_query(spark, ENTRY_DIR)


# --- helpers -----------------------------------------------------------------------


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Read the tables and offer them to SQL under their names."""
    frames = []
    for name in names:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        df.createOrReplaceTempView(name)
        frames.append(df)
    return frames


_scratch: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession) -> str:
    """A fresh database in the folder the cluster shares, or else in the warehouse.

    Results are lazy and read its tables, so it is dropped when the interpreter ends.
    """
    name = f"tableops_{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", "")
    at = f" LOCATION '{shared.rstrip('/')}/{name}'" if shared else ""
    spark.sql(f"CREATE DATABASE {name}{at}")
    _scratch.append((spark, name))
    return name


@atexit.register
def drop_scratch() -> None:
    """Drop the databases made for queries, where their session still runs."""
    while _scratch:
        spark, name = _scratch.pop()
        with contextlib.suppress(Exception):
            if spark._jsc is not None and not spark._jsc.sc().isStopped():
                spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def day_bounds(events: DataFrame) -> tuple:
    """First day of the events and the day after the last."""
    row = events.agg(
        F.to_date(F.min("ts")).alias("first"), F.date_add(F.to_date(F.max("ts")), 1).alias("stop")
    ).first()
    return row["first"], row["stop"]


def filled_counts(df: DataFrame) -> DataFrame:
    """Per column of a frame, how many values are not NULL."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "col_name", "n_values")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality, which is NULL where there is no label."""
    load(spark, sf_dir, "documents", "labels")
    return run_sql(
        spark,
        """SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS quality
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    )


def daily_events(spark: SparkSession, sf_dir: str, table: str) -> None:
    """Events as a table partitioned by day."""
    (events,) = load(spark, sf_dir, "events")
    save_table(spark, events.withColumn("day", F.to_date("ts")), table, partition_by=["day"])


# --- SQL carried to Spark ----------------------------------------------------------


def sql_filter_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "lineitem")
    return run_sql(
        spark,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
           FROM lineitem WHERE l_discount < 0.05 GROUP BY l_returnflag, l_linestatus""",
    )


def sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation; counted per customer before the join, so no customer is too big."""
    load(spark, sf_dir, "orders", "customer", "nation")
    return run_sql(
        spark,
        """WITH per_customer AS (
             SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
           SELECT n_name, sum(n) AS n_orders FROM per_customer
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           GROUP BY n_name""",
    )


def sql_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "documents", "labels")
    return run_sql(
        spark,
        """SELECT doc_id, lang FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    )


def sql_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "lineitem")
    return run_sql(
        spark,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q
           FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    )


def sql_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number each customer's orders by date, a day at a time.

    The rows are numbered within customer and date, and the customer's orders of earlier
    dates are added from the daily counts, so that a customer with a large share of all
    orders is not sorted in one task.
    """
    load(spark, sf_dir, "orders")
    return run_sql(
        spark,
        """WITH daily AS (
             SELECT o_custkey, o_orderdate, count(*) AS n FROM orders
             GROUP BY o_custkey, o_orderdate),
           earlier AS (
             SELECT o_custkey, o_orderdate,
               sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) - n AS n
             FROM daily)
           SELECT p.o_custkey, o_orderkey, e.n + row_number() OVER (
             PARTITION BY p.o_custkey, p.o_orderdate ORDER BY o_orderkey) AS rn
           FROM orders p JOIN earlier e
             ON p.o_custkey <=> e.o_custkey AND p.o_orderdate <=> e.o_orderdate""",
    )


def sql_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by bands of value; the bands are a derived table of literal rows."""
    load(spark, sf_dir, "events")
    return run_sql(
        spark,
        """SELECT band, count(*) AS n FROM events
           JOIN (VALUES ('low', -1e9, 10.0), ('middle', 10.0, 50.0), ('high', 50.0, 1e9))
             AS bands(band, at_least, below) ON value >= at_least AND value < below
           GROUP BY band""",
    )


def sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "customer")
    return run_sql(
        spark,
        """SELECT c_mktsegment, count(*) AS n FROM customer
           WHERE c_acctbal > :floor AND c_mktsegment <> :segment GROUP BY c_mktsegment""",
        {"floor": 100.0, "segment": "BUILDING"},
    )


def sql_format_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "part")
    return run_sql(
        spark,
        """SELECT p_brand, count(*) AS n FROM part
           WHERE p_size >= %s AND p_name LIKE '%%e%%' AND p_brand NOT IN %s GROUP BY p_brand""",
        [10, ["Brand#1", "Brand#2"]],
        format_slots=True,
    )


def row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    return run_sql(
        spark,
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
        limit=10,
    )


def read_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "supplier")
    return run_sql(spark, "SELECT s_suppkey, s_name, s_acctbal FROM supplier", partitions=4)


def pandas_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    frame = run_sql_pandas(
        spark,
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day, o_totalprice FROM orders",
        parse_dates=True,
        columns=["id", "day", "price"],
        index_col="id",
    )
    return frame.to_spark(index_col="id")


def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "lineitem", "orders")
    return run_sql(
        spark,
        """SELECT l_returnflag AS flag FROM lineitem
           UNION SELECT o_orderstatus AS flag FROM orders""",
    )


def array_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "embeddings")
    return run_sql(
        spark,
        "SELECT vec_id, size(embedding) AS dims, element_at(embedding, 1) AS first FROM embeddings",
    )


def map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "events")
    return run_sql(
        spark,
        """SELECT event_id, element_at(map_from_arrays(
             array('k', 'v'), array(event_type, CAST(user_id AS STRING))), 'v') AS v
           FROM events""",
    )


# --- results and columns -----------------------------------------------------------


def result_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "events")
    result = run_sql(spark, "SELECT * FROM events")
    return result_schema(result).join(filled_counts(result), "col_name")


def cast_temporal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "events")
    text = run_sql(
        spark,
        """SELECT event_id, CAST(ts AS STRING) AS ts, CAST(CAST(ts AS DATE) AS STRING) AS d
           FROM events""",
    )
    return cast_temporal(text, {"ts": "timestamp", "d": "date"})


def cast_temporal_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    text = run_sql(
        spark,
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending'
             ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS closed FROM orders""",
    )
    return cast_temporal(text, {"closed": "date"}, lenient=True)


def cast_temporal_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and times written in a format of their own, read back strictly."""
    (orders,) = load(spark, sf_dir, "orders")
    text = orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("placed_on"),
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("placed_at"),
    )
    return cast_temporal(
        text,
        {"placed_on": "date", "placed_at": "timestamp"},
        formats={"placed_on": "dd/MM/yyyy", "placed_at": "dd/MM/yyyy HH:mm"},
    )


def apply_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "customer")
    result = run_sql(
        spark, "SELECT c_custkey, c_nationkey, round(c_acctbal, 2) AS c_acctbal FROM customer"
    )
    return apply_schema(result, {"id": "varchar(20)", "nation": "bigint", "bal": "double"})


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "lineitem")
    return normalize_nulls(
        run_sql(
            spark,
            """SELECT l_orderkey, l_linenumber,
                 CASE l_returnflag WHEN 'R' THEN 'null' WHEN 'A' THEN 'NaN'
                   ELSE l_returnflag END AS flag,
                 CASE WHEN l_discount = 0 THEN double('NaN') ELSE l_discount END AS discount
               FROM lineitem""",
        )
    )


# --- writes ------------------------------------------------------------------------


def expression_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = load(spark, sf_dir, "part")
    table = f"{scratch(spark)}.parts"
    save_table(
        spark,
        part.select("p_partkey", "p_name", "p_retailprice"),
        table,
        expressions={"p_name": "substr(p_name, 1, 5)", "twice": "p_retailprice * 2"},
    )
    return run_sql(spark, f"SELECT p_partkey, p_name AS short_name, twice FROM {table}")


def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = load(spark, sf_dir, "customer")
    table = f"{scratch(spark)}.customers"
    save_table(spark, customer, table)
    return spark.table(table)


def create_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    return spark.table(table)


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "customer", "supplier")
    table = f"{scratch(spark)}.parties"
    first = run_sql(spark, "SELECT c_custkey AS id, c_name AS name FROM customer")
    more = run_sql(spark, "SELECT s_suppkey, s_name FROM supplier")
    save_table(spark, first, table, if_exists="append")
    save_table(spark, more, table, if_exists="append")
    return spark.table(table)


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "customer", "supplier")
    table = f"{scratch(spark)}.parties"
    save_table(spark, run_sql(spark, "SELECT c_custkey AS id, c_name AS name FROM customer"), table)
    swapped = run_sql(spark, "SELECT s_name AS name, s_suppkey AS id FROM supplier")
    save_table(spark, swapped, table, if_exists="append", match="name")
    return spark.table(table)


def bulk_insert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    table = f"{scratch(spark)}.prices"
    orders = run_sql(spark, "SELECT o_orderkey, o_totalprice FROM orders")
    save_table(spark, orders, table)
    text = run_sql(
        spark, "SELECT CAST(o_orderkey AS STRING), CAST(o_totalprice AS STRING) FROM orders"
    )
    bulk_insert(spark, table, text)
    return spark.table(table)


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "part")
    table = f"{scratch(spark)}.parts"
    save_table(spark, run_sql(spark, "SELECT p_partkey, p_brand, p_size FROM part"), table)
    fresh = run_sql(
        spark,
        f"""SELECT p_partkey + 100, upper(p_brand), CAST(p_size AS STRING)
            FROM {table} WHERE p_size > 1""",
        schema=["a", "b", "c"],
    )
    save_table(spark, fresh, table, if_exists="replace")
    return spark.table(table)


def replace_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    table = f"{scratch(spark)}.orders"
    save_table(spark, run_sql(spark, "SELECT o_orderkey, o_orderstatus FROM orders"), table)
    fresh = run_sql(spark, "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
    save_table(
        spark,
        fresh,
        table,
        if_exists="replace",
        schema={"id": "varchar(20)", "price": "double", "status": "varchar"},
        partition_by=["status"],
    )
    return spark.table(table)


def create_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    table = f"{scratch(spark)}.parts"
    part = run_sql(spark, "SELECT o_custkey, o_orderstatus FROM orders")
    create_from_data(spark, table, part, part, schema={"cust": "bigint", "status": "varchar(1)"})
    return spark.table(table)


def pandas_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas frame, as a caller holds it, written with the columns its dtypes ask for."""
    (supplier,) = load(spark, sf_dir, "supplier")
    held = supplier.selectExpr(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_acctbal < 0 AS owes",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, s_suppkey) AS seen",
    ).toPandas()
    table = f"{scratch(spark)}.suppliers"
    save_table(spark, held, table)
    return spark.table(table).withColumn("seen", F.col("seen").cast("timestamp_ntz"))


def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each write reports, beside what the tables then hold."""
    load(spark, sf_dir, "orders")
    database = scratch(spark)
    orders = run_sql(spark, "SELECT o_orderkey, o_custkey FROM orders")
    created = save_table(spark, orders, f"{database}.a")
    appended = save_table(spark, orders, f"{database}.a", if_exists="append")
    replaced = save_table(spark, orders, f"{database}.a", if_exists="replace")
    return spark.table(f"{database}.a").agg(
        F.lit(created).cast("bigint").alias("created"),
        F.lit(appended).cast("bigint").alias("appended"),
        F.lit(replaced).cast("bigint").alias("replaced"),
        F.count(F.lit(1)).alias("held"),
    )


# --- table maintenance -------------------------------------------------------------


def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    return table_schema(spark, table).join(filled_counts(spark.table(table)), "col_name")


def rename_and_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = load(spark, sf_dir, "orders")
    database = scratch(spark)
    save_table(spark, orders, f"{database}.first")
    run_sql(spark, f"CREATE TABLE {database}.second AS SELECT * FROM {database}.first")
    run_sql(spark, f"DROP TABLE {database}.first")
    run_sql(spark, f"ALTER TABLE {database}.second RENAME TO {database}.first")
    return run_sql(spark, f"SELECT * FROM {database}.first")


def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = load(spark, sf_dir, "customer")
    table = f"{scratch(spark)}.customers"
    save_table(spark, customer, table)
    update_table(spark, table, {"c_acctbal": "0"}, "c_acctbal < 0")
    return spark.table(table)


def update_null_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.documents"
    save_table(spark, labelled_documents(spark, sf_dir), table)
    update_table(spark, table, {"quality": "9"}, "quality = 1")
    return spark.table(table)


def update_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.documents"
    save_table(spark, labelled_documents(spark, sf_dir), table)
    updated = update_table(spark, table, {"quality": "9"}, "quality = 1")
    return spark.table(table).agg(
        F.lit(updated).cast("bigint").alias("updated"), F.count(F.lit(1)).alias("total")
    )


def update_all_retyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders")
    table = f"{scratch(spark)}.orders"
    text = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS STRING) AS placed FROM orders"
    save_table(spark, run_sql(spark, text), table)
    sets = {"placed": "cast(placed AS date)", "o_custkey": "o_orderkey", "o_orderkey": "o_custkey"}
    update_table(spark, table, sets, retype=True)
    return spark.table(table)


def update_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    update_table(spark, table, {"value": "value * 2", "props": "NULL"}, "event_type = 'click'")
    return spark.table(table)


def update_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    update_table(
        spark,
        table,
        {"value": "value + 1"},
        "user_id IS NOT NULL",
        only_partitions="day >= DATE '2024-01-05' AND day < DATE '2024-01-07'",
    )
    return spark.table(table)


def update_hit_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update whose rows all lie in two of the partitions; the others keep their files."""
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    before = files_by_day(spark.table(table)).select("file").distinct()
    before = spark.createDataFrame(before.collect(), "old_file string")
    hit = "ts >= TIMESTAMP_NTZ '2024-01-05 00:00:00' AND ts < TIMESTAMP_NTZ '2024-01-07 00:00:00'"
    update_table(spark, table, {"value": "value + 1", "props": "NULL"}, hit)
    held = files_by_day(spark.table(table))
    return held.join(before, held.file == before.old_file, "left").select(
        "event_id", "value", "props", "day", F.col("old_file").isNull().alias("rewritten")
    )


def files_by_day(events: DataFrame) -> DataFrame:
    return events.select("*", F.col("_metadata.file_name").alias("file"))


def update_partition_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    update_table(spark, table, {"day": "last_day(day)"}, "value > 50")
    return spark.table(table)


def swap_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch(spark)
    daily_events(spark, sf_dir, f"{database}.events")
    high = run_sql(spark, f"SELECT * FROM {database}.events WHERE value > 50")
    save_table(spark, high, f"{database}.high", partition_by=["day"])
    swap_tables(spark, f"{database}.high", f"{database}.events", keep_backup=True)
    return run_sql(
        spark,
        f"""SELECT event_id, value, day, 'new' AS side FROM {database}.events
            UNION ALL SELECT event_id, value, day, 'old' FROM {database}.events___old""",
    )


def swap_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A swap left between its two renames, as by a lost process, and ended by the next call."""
    database = scratch(spark)
    daily_events(spark, sf_dir, f"{database}.events")
    high = run_sql(spark, f"SELECT * FROM {database}.events WHERE value > 50")
    save_table(spark, high, f"{database}.high", partition_by=["day"])
    old = TableName(database, "events")
    set_note(spark, old, SWAP, [database, "high", True])
    rename_table(spark, old, old.with_suffix(BACKUP_SUFFIX))
    recover_table(spark, f"{database}.events")
    return run_sql(
        spark,
        f"""SELECT event_id, event_type, day, 'new' AS side FROM {database}.events
            UNION ALL SELECT event_id, event_type, day, 'old' FROM {database}.events___old""",
    )


def rebuild_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = load(spark, sf_dir, "customer")
    table = f"{scratch(spark)}.customers"
    save_table(spark, customer.repartition(16), table)
    rebuild_table(spark, table)
    return spark.table(table)


def rebuild_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lineitem,) = load(spark, sf_dir, "lineitem")
    table = f"{scratch(spark)}.lines"
    save_table(spark, lineitem, table)
    rebuild_table(spark, table, cluster_by=["l_partkey", "l_shipdate"])
    return spark.table(table)


def rebuild_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    rebuild_table(spark, table)
    return run_sql(
        spark,
        f"""SELECT *, 'new' AS side FROM {table} UNION ALL SELECT *, 'old' FROM {table}___old""",
    )


# --- scripts and backfill ----------------------------------------------------------


def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one file a day, but for two days that rows were appended to five times: files of
    each day before and after, and whether its rows stayed and a second call wrote nothing."""
    table = f"{scratch(spark)}.events"
    daily_events(spark, sf_dir, table)
    compact_table(spark, table)
    days = "day IN (DATE '2024-01-05', DATE '2024-01-06')"
    for k in range(5):
        save_table(spark, spark.table(table).where(days).where(F.col("event_id") % 5 == k), table, "append")

    def held(name: str) -> DataFrame:
        rows = files_by_day(spark.table(table)).groupBy(F.col("day").alias(f"{name}_day"))
        return rows.agg(F.count_distinct("file").alias(f"files_{name}"), F.count(F.lit(1)).alias(f"n_{name}"))

    before = spark.createDataFrame(held("before").collect(), held("before").schema)
    rewritten, again = compact_table(spark, table), compact_table(spark, table)
    after = held("after")
    return after.join(before, after.after_day == before.before_day).select(
        F.col("after_day").alias("day"), "files_after", (F.col("files_before") > 2).alias("had_many"),
        F.col("n_after").alias("n"), (F.col("n_after") == F.col("n_before")).alias("kept"),
        F.lit(rewritten).alias("rewritten"), F.lit(again).alias("again"),
    )


def script_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders", "customer")
    database = scratch(spark)
    result = run_script(
        spark,
        f"""
        -- buyers; each once
        DROP TABLE IF EXISTS {database}.buyers;
        CREATE TABLE {database}.buyers AS SELECT DISTINCT o_custkey FROM orders;
        /* segments; of the buyers */
        CREATE TABLE {database}.segments AS
        SELECT c_mktsegment AS seg, count(*) AS n, 'a;b' AS mark
        FROM {database}.buyers JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment;
        """,
    )
    if not result["succeeded"]:
        raise RuntimeError(result["error"])
    return spark.table(f"{database}.segments")


def script_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script whose second statement fails, taken up again once the cause is gone."""
    load(spark, sf_dir, "orders", "customer")
    database = scratch(spark)
    broken = run_script(
        spark,
        [
            f"CREATE TABLE {database}.spent AS "
            "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
            f"CREATE TABLE {database}.named AS SELECT c_name, n FROM {database}.spent "
            f"JOIN {database}.people ON o_custkey = c_custkey",
            f"DROP TABLE {database}.spent",
        ],
    )
    if broken["succeeded"] or len(broken["sqls"]) != 2:
        raise RuntimeError(f"Expected the second statement to fail: {broken}")
    people = run_sql(spark, "SELECT c_custkey, c_name FROM customer")
    save_table(spark, people, f"{database}.people")
    resumed = run_script(spark, broken["sqls"])
    if not resumed["succeeded"]:
        raise RuntimeError(resumed["error"])
    return spark.table(f"{database}.named")


DAY_QUERY = """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM {source}
    WHERE on_day >= {start} AND on_day < {stop} GROUP BY event_type
"""


def days_to_fill(spark: SparkSession, events: DataFrame) -> tuple[str, str]:
    """Events partitioned by day, so that a day reads its own partition, and a table to fill."""
    database = scratch(spark)
    source, table = f"{database}.events_by_day", f"{database}.by_day"
    dated = events.withColumn("on_day", F.to_date("ts"))
    save_table(spark, dated, source, partition_by=["on_day"])
    spark.sql(
        f"""CREATE TABLE {table} (event_type STRING, n BIGINT, total DOUBLE, day DATE)
            USING parquet PARTITIONED BY (day)"""
    )
    return source, table


def backfill_daily_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    (events,) = load(spark, sf_dir, "events")
    source, table = days_to_fill(spark, events)
    query = DAY_QUERY.format(source=source, start=":start_time", stop=":stop_time")
    result = backfill_daily(spark, query, *day_bounds(events), into=table)
    if not result["succeeded"]:
        raise RuntimeError(result["error"])
    return spark.table(table)


def backfill_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a plain script, which names its day in text and its partition itself."""
    (events,) = load(spark, sf_dir, "events")
    source, table = days_to_fill(spark, events)
    query = DAY_QUERY.format(source=source, start="DATE '$START_TIME'", stop="DATE '$STOP_TIME'")
    script = f"INSERT OVERWRITE TABLE {table} PARTITION (day = DATE '$START_TIME') {query};"
    result = backfill_daily(spark, script, *day_bounds(events))
    if not result["succeeded"]:
        raise RuntimeError(result["error"])
    return spark.table(table)


def backfill_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the days, then all: the second run leaves the recorded ones out."""
    (events,) = load(spark, sf_dir, "events")
    source, table = days_to_fill(spark, events)
    query = DAY_QUERY.format(source=source, start=":start_time", stop=":stop_time")
    first, stop = day_bounds(events)
    half = first + (stop - first) / 2
    ledger = f"{table}_ledger"
    backfill_daily(spark, query, first, half, into=table, ledger=ledger)
    result = backfill_daily(spark, query, first, stop, into=table, ledger=ledger)
    if not result["succeeded"]:
        raise RuntimeError(result["error"])
    skipped = spark.createDataFrame([(d,) for d in result["skipped"]], "skipped date")
    held = spark.table(table)
    return held.join(F.broadcast(skipped), held.day == skipped.skipped, "left").select(
        "event_type", "n", "total", "day", F.col("skipped").isNotNull().alias("from_first_run")
    )


def backfill_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two days come late: only these days are filled again."""
    (events,) = load(spark, sf_dir, "events")
    source, table = days_to_fill(spark, events)
    query = DAY_QUERY.format(source=source, start=":start_time", stop=":stop_time")
    first, stop = day_bounds(events)
    late = (F.to_date("ts").isin(first, first + (stop - first) / 2)) & (F.col("event_id") % 2 == 0)
    everything = spark.table(source)
    early = f"{source}_early"
    save_table(spark, everything.where(~F.coalesce(late, F.lit(False))), early, partition_by=["on_day"])
    query = query.replace(source, early)
    given = {"into": table, "ledger": f"{table}_ledger", "source": early}
    backfill_daily(spark, query, first, stop, **given)
    save_table(spark, everything.where(late), early, if_exists="append")
    result = backfill_daily(spark, query, first, stop, **given)
    if not result["succeeded"]:
        raise RuntimeError(result["error"])
    again = spark.createDataFrame([(d,) for d in result["days"]], "again date")
    held = spark.table(table)
    return held.join(F.broadcast(again), held.day == again.again, "left").select(
        "event_type", "n", "total", "day", F.col("again").isNotNull().alias("filled_again")
    )


def backfill_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    (events,) = load(spark, sf_dir, "events")
    table = f"{scratch(spark)}.by_day"
    spark.sql(
        f"""CREATE TABLE {table} (event_type STRING, n BIGINT, total DOUBLE, day DATE)
            USING parquet PARTITIONED BY (day)"""
    )
    backfill_range(
        spark,
        """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, to_date(ts) AS day
           FROM events WHERE ts >= :start_time AND ts < :stop_time
           GROUP BY event_type, to_date(ts)""",
        *day_bounds(events),
        into=table,
    )
    return spark.table(table)


def daily_slices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    (events,) = load(spark, sf_dir, "events")
    first, stop = day_bounds(events)
    return daily_slices(
        events,
        "ts",
        first,
        stop,
        F.count("event_id").alias("n_events"),
        F.count_distinct("user_id").alias("n_users"),
    )


def text_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries of the optional subpackage for training text and their SQL; none where it is absent."""
    try:
        import corpus_pipeline
        from tableops.llm.queries import ORACLE_SQL, QUERIES
    except ModuleNotFoundError as error:
        if not (error.name or "").startswith(("corpus_pipeline", "tableops.llm")):
            raise
        return {}, {}
    sql = dict(ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to a callable over (session, folder of the tables)."""
    return {
        **text_queries()[0],
        "sql_filter_agg": sql_filter_agg,
        "sql_join": sql_join,
        "sql_anti_join": sql_anti_join,
        "sql_rollup": sql_rollup,
        "sql_window": sql_window,
        "sql_params": sql_params,
        "sql_format_slots": sql_format_slots,
        "row_limit": row_limit,
        "read_partitions": read_partitions,
        "pandas_result": pandas_result,
        "union_distinct": union_distinct,
        "array_column": array_column,
        "map_column": map_column,
        "result_schema": result_schema_query,
        "cast_temporal": cast_temporal_query,
        "cast_temporal_lenient": cast_temporal_lenient,
        "cast_temporal_format": cast_temporal_format,
        "sql_range_join": sql_range_join,
        "apply_schema": apply_schema_query,
        "null_tokens": null_tokens,
        "expression_column": expression_column,
        "create_table": create_table,
        "create_partitioned": create_partitioned,
        "append_rows": append_rows,
        "append_by_name": append_by_name,
        "bulk_insert": bulk_insert_query,
        "replace_table": replace_table,
        "replace_structure": replace_structure,
        "create_from_parts": create_from_parts,
        "pandas_input": pandas_input,
        "write_counts": write_counts,
        "table_metadata": table_metadata,
        "rename_and_drop": rename_and_drop,
        "update_rows": update_rows,
        "update_null_predicate": update_null_predicate,
        "update_count": update_count,
        "update_all_retyped": update_all_retyped,
        "update_partitioned": update_partitioned,
        "update_one_day": update_one_day,
        "update_hit_partitions": update_hit_partitions,
        "update_partition_column": update_partition_column,
        "swap_tables": swap_tables_query,
        "swap_recovered": swap_recovered,
        "rebuild_table": rebuild_table_query,
        "rebuild_clustered": rebuild_clustered,
        "rebuild_partitioned": rebuild_partitioned,
        "compact_partitions": compact_partitions,
        "script_pipeline": script_pipeline,
        "script_resume": script_resume,
        "backfill_daily": backfill_daily_query,
        "backfill_template": backfill_template,
        "backfill_ledger": backfill_ledger,
        "backfill_late": backfill_late,
        "backfill_range": backfill_range_query,
        "daily_slices": daily_slices_query,
    }


def _columns_sql(table: str, columns: list[tuple[str, str, str]]) -> str:
    """Position, name, Spark type and filled count of each column, counted from the table."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, {pos} AS pos, '{kind}' AS col_type, "
        f"count({source}) AS n_values FROM {table}"
        for pos, (name, kind, source) in enumerate(columns)
    )


EVENT_COLUMNS = [
    ("event_id", "bigint", "event_id"),
    ("ts", "timestamp_ntz", "ts"),
    ("user_id", "bigint", "user_id"),
    ("event_type", "string", "event_type"),
    ("value", "double", "value"),
    ("props", "string", "props"),
]


def oracle_sql() -> dict[str, str]:
    """The same answers stated in plain SQL over the given tables."""
    by_day = """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total,
                  CAST(ts AS DATE) AS day FROM events GROUP BY event_type, CAST(ts AS DATE)"""
    parties = """SELECT c_custkey AS id, c_name AS name FROM customer
                 UNION ALL SELECT s_suppkey, s_name FROM supplier"""
    return {
        **text_queries()[1],
        "cast_temporal_format": """
            SELECT o_orderkey, CAST(o_orderdate AS DATE) AS placed_on,
              date_trunc('minute', o_orderdate) AS placed_at FROM orders""",
        "sql_range_join": """
            SELECT CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'middle' ELSE 'high' END
              AS band, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1""",
        "sql_filter_agg": """
            SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
            FROM lineitem WHERE l_discount < 0.05 GROUP BY l_returnflag, l_linestatus""",
        "sql_join": """
            SELECT n_name, count(*) AS n_orders FROM orders
            JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            GROUP BY n_name""",
        "sql_anti_join": """
            SELECT doc_id, lang FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "sql_rollup": """
            SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q
            FROM lineitem GROUP BY l_returnflag, l_linestatus
            UNION ALL SELECT l_returnflag, NULL, count(*), round(sum(l_quantity), 2)
            FROM lineitem GROUP BY l_returnflag
            UNION ALL SELECT NULL, NULL, count(*), round(sum(l_quantity), 2) FROM lineitem""",
        "sql_window": """
            SELECT o_custkey, o_orderkey, CAST(row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rn
            FROM orders""",
        "sql_params": """
            SELECT c_mktsegment, count(*) AS n FROM customer
            WHERE c_acctbal > 100.0 AND c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment""",
        "sql_format_slots": """
            SELECT p_brand, count(*) AS n FROM part
            WHERE p_size >= 10 AND p_name LIKE '%e%' AND p_brand NOT IN ('Brand#1', 'Brand#2')
            GROUP BY p_brand""",
        "row_limit": """
            SELECT o_orderkey, o_totalprice FROM orders
            ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
        "read_partitions": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
        "pandas_result": """
            SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day,
              o_totalprice AS price FROM orders""",
        "union_distinct": """
            SELECT DISTINCT flag FROM (SELECT l_returnflag AS flag FROM lineitem
            UNION ALL SELECT o_orderstatus FROM orders)""",
        "array_column": """
            SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, embedding[1] AS first
            FROM embeddings""",
        "map_column": "SELECT event_id, CAST(user_id AS VARCHAR) AS v FROM events",
        "result_schema": _columns_sql("events", EVENT_COLUMNS),
        "cast_temporal": "SELECT event_id, ts, CAST(ts AS DATE) AS d FROM events",
        "cast_temporal_lenient": """
            SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END
              AS closed FROM orders""",
        "apply_schema": """
            SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS BIGINT) AS nation,
              round(c_acctbal, 2) AS bal FROM customer""",
        "null_tokens": """
            SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag NOT IN ('R', 'A') THEN l_returnflag END AS flag,
              nullif(l_discount, 0) AS discount FROM lineitem""",
        "expression_column": """
            SELECT p_partkey, substr(p_name, 1, 5) AS short_name, p_retailprice * 2 AS twice
            FROM part""",
        "create_table": "SELECT * FROM customer",
        "create_partitioned": "SELECT *, CAST(ts AS DATE) AS day FROM events",
        "append_rows": parties,
        "append_by_name": parties,
        "bulk_insert": """
            SELECT o_orderkey, o_totalprice FROM orders
            UNION ALL SELECT o_orderkey, o_totalprice FROM orders""",
        "replace_table": """
            SELECT p_partkey + 100 AS p_partkey, upper(p_brand) AS p_brand, p_size
            FROM part WHERE p_size > 1""",
        "replace_structure": """
            SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS price,
              o_orderstatus AS status FROM orders""",
        "create_from_parts": """
            SELECT o_custkey AS cust, o_orderstatus AS status FROM orders
            UNION ALL SELECT o_custkey, o_orderstatus FROM orders""",
        "pandas_input": """
            SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_acctbal < 0 AS owes,
              TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey AS BIGINT)) AS seen
            FROM supplier""",
        "write_counts": """
            SELECT count(*) AS created, count(*) AS appended, count(*) AS replaced,
              count(*) AS held FROM orders""",
        "table_metadata": _columns_sql("events", [*EVENT_COLUMNS, ("day", "date", "ts")]),
        "rename_and_drop": "SELECT * FROM orders",
        "update_rows": """
            SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
              c_mktsegment FROM customer""",
        "update_null_predicate": """
            SELECT d.doc_id, CAST(CASE WHEN l.quality = 1 THEN 9 ELSE l.quality END AS DOUBLE)
              AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "update_count": """
            SELECT count(*) FILTER (WHERE quality = 1) AS updated, count(*) AS total
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "update_all_retyped": """
            SELECT o_custkey AS o_orderkey, o_orderkey AS o_custkey,
              CAST(o_orderdate AS DATE) AS placed FROM orders""",
        "update_partitioned": """
            SELECT event_id, ts, user_id, event_type,
              CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value,
              CASE WHEN event_type <> 'click' THEN props END AS props,
              CAST(ts AS DATE) AS day FROM events""",
        "update_one_day": """
            SELECT event_id, ts, user_id, event_type,
              CASE WHEN ts >= '2024-01-05' AND ts < '2024-01-07' THEN value + 1 ELSE value END
              AS value, props, CAST(ts AS DATE) AS day FROM events""",
        "update_hit_partitions": """
            SELECT event_id, CASE WHEN hit THEN value + 1 ELSE value END AS value,
              CASE WHEN NOT hit THEN props END AS props, CAST(ts AS DATE) AS day, hit AS rewritten
            FROM (SELECT *, ts >= '2024-01-05' AND ts < '2024-01-07' AS hit FROM events)""",
        "update_partition_column": """
            SELECT event_id, ts, user_id, event_type, value, props,
              CASE WHEN value > 50 THEN last_day(ts) ELSE CAST(ts AS DATE) END AS day
            FROM events""",
        "swap_tables": """
            SELECT event_id, value, CAST(ts AS DATE) AS day, 'new' AS side FROM events
            WHERE value > 50
            UNION ALL SELECT event_id, value, CAST(ts AS DATE), 'old' FROM events""",
        "swap_recovered": """
            SELECT event_id, event_type, CAST(ts AS DATE) AS day, 'new' AS side
            FROM events WHERE value > 50
            UNION ALL SELECT event_id, event_type, CAST(ts AS DATE), 'old' FROM events""",
        "rebuild_table": "SELECT * FROM customer",
        "rebuild_clustered": "SELECT * FROM lineitem",
        "rebuild_partitioned": """
            SELECT *, CAST(ts AS DATE) AS day, 'new' AS side FROM events
            UNION ALL SELECT *, CAST(ts AS DATE), 'old' FROM events""",
        "compact_partitions": """
            SELECT CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS files_after,
              CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06') AS had_many,
              count(*) * CASE WHEN CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')
                THEN 2 ELSE 1 END AS n,
              true AS kept, CAST(2 AS INTEGER) AS rewritten, CAST(0 AS INTEGER) AS again
            FROM events GROUP BY CAST(ts AS DATE)""",
        "script_pipeline": """
            SELECT c_mktsegment AS seg, count(*) AS n, 'a;b' AS mark FROM customer
            WHERE c_custkey IN (SELECT o_custkey FROM orders) GROUP BY c_mktsegment""",
        "script_resume": """
            SELECT c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n
            FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
        "backfill_daily": by_day,
        "backfill_template": by_day,
        "backfill_ledger": f"""
            WITH bounds AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) + 1 AS hi FROM events)
            SELECT b.*, day < lo + CAST((hi - lo) // 2 AS INTEGER) AS from_first_run
            FROM ({by_day}) b, bounds""",
        "backfill_late": f"""
            WITH bounds AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) + 1 AS hi FROM events)
            SELECT b.*, day IN (lo, lo + CAST((hi - lo) // 2 AS INTEGER)) AS filled_again
            FROM ({by_day}) b, bounds""",
        "backfill_range": by_day,
        "daily_slices": """
            SELECT CAST(d.day AS DATE) AS day, count(e.event_id) AS n_events,
              count(DISTINCT e.user_id) AS n_users
            FROM generate_series((SELECT CAST(min(ts) AS DATE) FROM events),
              (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY) d(day)
            LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(d.day AS DATE) GROUP BY d.day""",
    }
