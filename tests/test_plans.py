import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableops import backfill_daily, backfill_range, daily_slices, run_script, save_table
from tableops.plans import backfill
from tableops.plans.script import split_script
from tests.plans import executed_plan, python_nodes


def rows(spark, table):
    return sorted((tuple(r) for r in spark.sql(f"SELECT * FROM {table}").collect()), key=repr)


# --- scripts -----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("script", "expected"),
    [
        ("", []),
        (" ;; \n; ", []),
        ("SELECT 1", ["SELECT 1"]),
        ("SELECT 1; SELECT 2;", ["SELECT 1", "SELECT 2"]),
        ("SELECT ';' AS a; SELECT 2", ["SELECT ';' AS a", "SELECT 2"]),
        ('SELECT ";", `a;b`; SELECT 2', ['SELECT ";", `a;b`', "SELECT 2"]),
        (r"SELECT 'it\'s;', 'it''s;'; SELECT 2", [r"SELECT 'it\'s;', 'it''s;'", "SELECT 2"]),
        (r"SELECT r'\'; SELECT 2", [r"SELECT r'\'", "SELECT 2"]),
        ("-- a; b\nSELECT 1; -- c;", ["-- a; b\nSELECT 1"]),
        ("/* a; 'b */ SELECT 1 /* ; */; /* ; */", ["/* a; 'b */ SELECT 1 /* ; */"]),
        ("SELECT 1 -- it's\n; SELECT 2", ["SELECT 1 -- it's", "SELECT 2"]),
        ("SELECT 'a -- b; /* c'; SELECT 2", ["SELECT 'a -- b; /* c'", "SELECT 2"]),
        ("SELECT 5 - -3; SELECT 4 / 2", ["SELECT 5 - -3", "SELECT 4 / 2"]),
    ],
)
def test_split(script, expected):
    assert split_script(script) == expected


PIECES = st.sampled_from(
    ["SELECT 1", " x ", "'a;b'", "'it''s'", r"'\';'", '"q;"', "`n;m`", "r'\\'", "-- c; 'd\n", "/* e; ' */", "/* a /* ; */ ; */", "-", "/"]
)


@given(st.lists(st.lists(PIECES, min_size=1, max_size=5).map(" ".join), max_size=6))
def test_split_undoes_join(statements):
    def has_code(text):
        for comment in ("-- c; 'd\n", "/* e; ' */", "/* a /* ; */ ; */"):
            text = text.replace(comment, "")
        return bool(text.strip())

    expected = [s.strip() for s in statements if has_code(s)]
    assert split_script("\n;\n".join(statements)) == expected


def test_resumed_script_equals_an_unbroken_one(spark, db):
    def script(table, gate):
        return f"""
            CREATE TABLE {db}.{table} (x INT) USING parquet;
            INSERT INTO {db}.{table} VALUES (1);
            INSERT INTO {db}.{table} SELECT x + 1 FROM {db}.{table};
            INSERT INTO {db}.{table} SELECT x + y FROM {db}.{table} CROSS JOIN {gate};
            INSERT INTO {db}.{table} SELECT max(x) * 10 FROM {db}.{table};
        """

    spark.sql(f"CREATE TABLE {db}.ready USING parquet AS SELECT 100 AS y")
    assert run_script(spark, script("whole", f"{db}.ready"))["succeeded"]
    broken = run_script(spark, script("resumed", f"{db}.late"))
    assert not broken["succeeded"] and len(broken["sqls"]) == 2
    spark.sql(f"CREATE TABLE {db}.late USING parquet AS SELECT 100 AS y")
    assert run_script(spark, broken["sqls"])["succeeded"]
    assert rows(spark, f"{db}.resumed") == rows(spark, f"{db}.whole")


def test_script_runs_in_order(spark, db):
    result = run_script(
        spark,
        f"""
        -- first; the table
        CREATE TABLE {db}.t (x INT, s STRING) USING parquet;
        INSERT INTO {db}.t VALUES (1, 'a;b'), (:n, "it's");
        /* a query; its rows are let go */
        SELECT * FROM {db}.t;
        INSERT INTO {db}.t SELECT x + 10, s FROM {db}.t;
        """,
        {"n": 2},
    )
    assert result == {"succeeded": True}
    assert rows(spark, f"{db}.t") == [(1, "a;b"), (11, "a;b"), (12, "it's"), (2, "it's")]


def test_script_stops_and_can_be_resumed(spark, db):
    script = f"""
        CREATE TABLE {db}.t (x INT) USING parquet;
        INSERT INTO {db}.t SELECT x FROM {db}.missing;
        INSERT INTO {db}.t VALUES (7);
    """
    result = run_script(spark, script)
    assert result["succeeded"] is False
    assert "TABLE_OR_VIEW_NOT_FOUND" in result["error"]
    assert len(result["sqls"]) == 2 and "missing" in result["sqls"][0]
    assert rows(spark, f"{db}.t") == []
    spark.sql(f"CREATE TABLE {db}.missing USING parquet AS SELECT 5 AS x")
    assert run_script(spark, result["sqls"]) == {"succeeded": True}
    assert rows(spark, f"{db}.t") == [(5,), (7,)]


def test_script_reports_a_query_that_fails_while_running(spark):
    result = run_script(spark, "SELECT CAST(concat('x', id) AS INT) FROM range(5); SELECT 1")
    assert result["succeeded"] is False and "CAST_INVALID_INPUT" in result["error"]
    assert len(result["sqls"]) == 2


def test_script_with_odd_queries(spark, db):
    assert run_script(spark, "SELECT 1 AS a, 2 AS a; SHOW TABLES; SELECT array(1), map('a', NULL), NULL")["succeeded"]
    assert run_script(spark, ["SELECT 1", " "])["succeeded"]
    assert run_script(spark, "")["succeeded"]


# --- backfill ----------------------------------------------------------------------

DAY_SQL = """SELECT kind, count(*) AS n FROM {db}.src
             WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind"""
RANGE_SQL = """SELECT kind, count(*) AS n, to_date(ts) AS day FROM {db}.src
               WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind, to_date(ts)"""


@pytest.fixture
def source(spark, db):
    """Three days around midnight, with nothing on the 10th, and a target by day."""
    frame = spark.createDataFrame(
        [
            ("a", dt.datetime(2019, 5, 8, 23, 59, 59)),
            ("a", dt.datetime(2019, 5, 9, 0, 0, 0)),
            ("b", dt.datetime(2019, 5, 9, 23, 59, 59, 999999)),
            ("a", dt.datetime(2019, 5, 11, 0, 0, 0)),
            ("a", dt.datetime(2019, 5, 11, 12, 0, 0)),
            ("b", dt.datetime(2019, 5, 12, 0, 0, 0)),
        ],
        "kind string, ts timestamp_ntz",
    )
    save_table(spark, frame, f"{db}.src")
    spark.sql(f"CREATE TABLE {db}.out (kind STRING, n BIGINT, day DATE) USING parquet PARTITIONED BY (day)")
    return frame


def day(n):
    return dt.date(2019, 5, n)


FULL = [("a", 1, day(9)), ("a", 2, day(11)), ("b", 1, day(9))]


def test_day_range_is_half_open(spark, db, source):
    result = backfill_daily(spark, DAY_SQL.format(db=db), day(9), day(11), into=f"{db}.out")
    assert result == {"succeeded": True, "days": [day(9), day(10)]}
    assert rows(spark, f"{db}.out") == [("a", 1, day(9)), ("b", 1, day(9))]
    assert backfill_daily(spark, DAY_SQL.format(db=db), "2019-05-11", "2019-05-11", into=f"{db}.out") == {
        "succeeded": True, "days": [],
    }


def test_template_placeholders(spark, db, source):
    template = f"""
        -- {{braces}} stay; so do ';' in text
        INSERT OVERWRITE TABLE {db}.out PARTITION (day = DATE '$START_TIME')
        SELECT concat(kind, '{{;}}'), count(*) FROM {db}.src
        WHERE ts >= DATE '$START_TIME' AND ts < DATE '$STOP_TIME' GROUP BY kind;
        SELECT '$START_TIME';
    """
    assert backfill_daily(spark, template, day(9), day(12))["succeeded"]
    assert rows(spark, f"{db}.out") == [(f"{k}{{;}}", n, d) for k, n, d in FULL]


def test_markers_in_a_partition_clause(spark, db, source):
    template = f"""INSERT OVERWRITE TABLE {db}.out PARTITION (day = :start_time)
        SELECT kind, count(*) FROM {db}.src WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind"""
    assert backfill_daily(spark, template, day(9), day(12))["succeeded"]
    assert rows(spark, f"{db}.out") == FULL


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_rerun_gives_the_same_and_clears_empty_days(spark, db, source, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    spark.sql(f"INSERT INTO {db}.out VALUES ('stale', 9, DATE'2019-05-10'), ('kept', 9, DATE'2019-05-20')")
    for _ in range(2):
        assert backfill_daily(spark, DAY_SQL.format(db=db) + " ;\n", day(9), day(12), into=f"{db}.out")["succeeded"]
        assert rows(spark, f"{db}.out") == sorted([*FULL, ("kept", 9, day(20))], key=repr)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")


def test_query_with_a_common_table_expression(spark, db, source):
    query = f"WITH d AS ({DAY_SQL.format(db=db)}) SELECT * FROM d -- all of them"
    assert backfill_daily(spark, query, day(9), day(12), into=f"{db}.out")["succeeded"]
    assert rows(spark, f"{db}.out") == FULL


def test_backfill_stops_at_the_failed_day(spark, db, source):
    query = f"""SELECT kind, IF(count(*) > 1, CAST(raise_error('too many') AS BIGINT), count(*)) FROM {db}.src
                WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind"""
    result = backfill_daily(spark, query, day(9), day(13), into=f"{db}.out")
    assert result["succeeded"] is False and "too many" in result["error"]
    assert result["days"] == [day(9), day(10)] and result["failed_day"] == day(11)
    assert len(result["sqls"]) == 1
    # Taken up again from the failed day.
    rest = backfill_daily(spark, DAY_SQL.format(db=db), result["failed_day"], day(12), into=f"{db}.out")
    assert rest["succeeded"] and rows(spark, f"{db}.out") == FULL


def test_only_the_day_is_written(spark, db, source):
    backfill_daily(spark, DAY_SQL.format(db=db), day(9), day(12), into=f"{db}.out")
    others = {f for f in spark.table(f"{db}.out").inputFiles() if "2019-05-11" not in f}
    backfill_daily(spark, DAY_SQL.format(db=db), day(11), day(12), into=f"{db}.out")
    assert others < set(spark.table(f"{db}.out").inputFiles())


def test_range_equals_day_by_day(spark, db, source):
    spark.sql(f"CREATE TABLE {db}.whole LIKE {db}.out")
    for table in ("out", "whole"):
        spark.sql(f"INSERT INTO {db}.{table} VALUES ('stale', 9, DATE'2019-05-10'), ('kept', 9, DATE'2019-05-20')")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    backfill_daily(spark, DAY_SQL.format(db=db), day(8), day(13), into=f"{db}.out")
    for _ in range(2):
        assert backfill_range(spark, RANGE_SQL.format(db=db), day(8), day(13), f"{db}.whole") == 5
        assert rows(spark, f"{db}.whole") == rows(spark, f"{db}.out")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert backfill_range(spark, RANGE_SQL.format(db=db), day(9), day(9), f"{db}.whole") == 0


def test_range_without_any_rows(spark, db, source):
    spark.sql(f"INSERT INTO {db}.out VALUES ('stale', 9, DATE'2019-05-10'), ('kept', 9, DATE'2019-05-20')")
    nothing = RANGE_SQL.format(db=db).replace("GROUP", "AND false GROUP")
    assert backfill_range(spark, nothing, day(9), day(12), f"{db}.out") == 0
    assert rows(spark, f"{db}.out") == [("kept", 9, day(20))]


def test_range_refuses_rows_outside_it(spark, db, source):
    spark.sql(f"INSERT INTO {db}.out VALUES ('kept', 9, DATE'2019-05-08')")
    loose = RANGE_SQL.format(db=db).replace(":start_time", "DATE'2019-05-01'")
    with pytest.raises(Exception, match="Day outside the range: 2019-05-08"):
        backfill_range(spark, loose, day(9), day(12), f"{db}.out")
    assert rows(spark, f"{db}.out") == [("kept", 9, day(8))]
    save_table(spark, source, f"{db}.flat")
    with pytest.raises(ValueError, match="partitioned by day alone"):
        backfill_range(spark, RANGE_SQL.format(db=db), day(9), day(12), f"{db}.flat")


def test_range_with_days_as_text(spark, db, source):
    spark.sql(f"CREATE TABLE {db}.text (kind STRING, n BIGINT, day STRING) USING parquet PARTITIONED BY (day)")
    spark.sql(f"INSERT INTO {db}.text VALUES ('stale', 9, '2019-05-10'), ('kept', 9, '2019-05-20')")
    for _ in range(2):
        assert backfill_range(spark, RANGE_SQL.format(db=db), day(9), day(12), f"{db}.text") == 3
        expected = [(k, n, str(d)) for k, n, d in FULL]
        assert rows(spark, f"{db}.text") == sorted([*expected, ("kept", 9, "2019-05-20")], key=repr)
    assert backfill_daily(spark, DAY_SQL.format(db=db), day(9), day(12), into=f"{db}.text")["succeeded"]
    assert rows(spark, f"{db}.text") == sorted([*expected, ("kept", 9, "2019-05-20")], key=repr)
    spark.sql(f"CREATE TABLE {db}.number (kind STRING, n BIGINT, day INT) USING parquet PARTITIONED BY (day)")
    with pytest.raises(ValueError, match="date or its text"):
        backfill_range(spark, RANGE_SQL.format(db=db), day(9), day(12), f"{db}.number")


def test_times_are_no_days(spark, db, source):
    with pytest.raises(ValueError, match="got a time"):
        backfill_daily(spark, "SELECT 1", dt.datetime(2019, 5, 9, 12), day(12))


def test_template_with_settings_and_commands(spark, db, source):
    template = f"""
        SET spark.sql.tableops_test = '$START_TIME';
        USE {db};
        CREATE OR REPLACE TEMPORARY VIEW one AS SELECT 1 AS x;
        CACHE TABLE one;
        UNCACHE TABLE one;
        ALTER TABLE out DROP IF EXISTS PARTITION (day = DATE'$START_TIME');
        INSERT INTO out SELECT kind, count(*), :start_time FROM src
        WHERE ts >= :start_time AND ts < :stop_time GROUP BY kind;
        ANALYZE TABLE out COMPUTE STATISTICS NOSCAN
    """
    try:
        result = backfill_daily(spark, template, day(9), day(12))
    finally:
        spark.sql("USE default")
        spark.catalog.dropTempView("one")
    assert result == {"succeeded": True, "days": [day(9), day(10), day(11)]}
    assert rows(spark, f"{db}.out") == FULL


def test_slices_equal_the_backfill(spark, db, source):
    sliced = daily_slices(
        spark.table(f"{db}.src"), "ts", day(8), day(13),
        F.count(F.lit(1)).alias("n"), F.count_distinct("kind").alias("kinds"), F.max("kind").alias("last"),
        F.collect_set("kind").alias("all"), F.min("ts").alias("first ts"),
    )
    got = {r.day: r for r in sliced.collect()}
    assert sorted(got) == [day(n) for n in range(8, 13)]
    assert [got[day(n)].n for n in range(8, 13)] == [1, 2, 0, 2, 1]
    assert [got[day(n)].kinds for n in range(8, 13)] == [1, 2, 0, 1, 1]
    assert tuple(got[day(10)]) == (day(10), 0, 0, None, [], None)
    backfill_daily(spark, DAY_SQL.format(db=db), day(8), day(13), into=f"{db}.out")
    per_day = spark.table(f"{db}.out").groupBy("day").agg(F.sum("n").alias("n")).collect()
    assert {r.day: r.n for r in per_day} == {d: r.n for d, r in got.items() if r.n}


def test_slices_of_nothing(spark, db, source):
    df = spark.table(f"{db}.src")
    assert daily_slices(df, "ts", day(9), day(9), F.count("kind").alias("n")).count() == 0
    empty = daily_slices(df.where("false"), "ts", day(9), day(11), F.count("kind").alias("n"))
    assert [r.n for r in empty.collect()] == [0, 0]
    dates = df.select(F.to_date("ts").alias("d"), "kind")
    assert [r.n for r in daily_slices(dates, "d", day(9), day(11), F.count("kind").alias("n")).orderBy("day").collect()] == [2, 0]


def test_slices_plan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = daily_slices(events, "ts", "2024-01-05", "2024-01-12", F.sum("value").alias("v"))
    plan = executed_plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-05T00:00), LessThan(ts,2024-01-12T00:00)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Scan parquet") == 2 and not python_nodes(df)  # listed in tree and details
    assert "partial_sum" in plan


def test_range_backfill_writes_in_one_job_of_the_query(spark, db, source, monkeypatch):
    plans = []
    real = backfill.counted_write

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args)

    monkeypatch.setattr(backfill, "counted_write", spy)
    backfill_range(spark, RANGE_SQL.format(db=db), day(9), day(12), f"{db}.out")
    assert len(plans) == 1 and plans[0].count("FileScan") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in plans[0]
