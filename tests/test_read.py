import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tableops import apply_schema, cast_temporal, normalize_nulls, result_schema, run_sql, run_sql_pandas
from tests.plans import executed_plan, python_nodes


@pytest.fixture
def items(spark):
    rows = [("cars", "sport", 1), ("cars", "family", 2), ("it's 5%", "sport", 3), (None, "sport", 4)]
    spark.createDataFrame(rows, "name string, category string, id int").createOrReplaceTempView("items")


def ids(df):
    return sorted(row.id for row in df.collect())


def test_params_by_position_and_name(spark, items):
    sql = "SELECT id FROM items WHERE name = {} AND category = {}"
    assert ids(run_sql(spark, sql.format("?", "?"), ["cars", "sport"])) == [1]
    assert ids(run_sql(spark, sql.format(":n", ":c"), {"n": "cars", "c": "family"})) == [2]


def test_params_as_format_slots(spark, items):
    sql = "SELECT id FROM items WHERE name = %s AND category = %s"
    assert ids(run_sql(spark, sql, ("cars", "sport"), format_slots=True)) == [1]
    named = "SELECT id FROM items WHERE name = %(n)s AND name LIKE '%%5%%'"
    assert ids(run_sql(spark, named, {"n": "it's 5%"}, format_slots=True)) == [3]
    among = "SELECT id FROM items WHERE name IN %s AND category = %s"
    assert ids(run_sql(spark, among, (["cars", "it's 5%"], "sport"), format_slots=True)) == [1, 3]
    among = "SELECT id FROM items WHERE id IN %(i)s AND id NOT IN %(j)s"
    assert ids(run_sql(spark, among, {"i": (1, 2), "j": [2]}, format_slots=True)) == [1]
    # Without arguments the text is taken as it is.
    assert ids(run_sql(spark, "SELECT id FROM items WHERE name LIKE '%5%'", format_slots=True)) == [3]


def test_params_are_values_not_text(spark, items):
    hostile = "x' OR '1'='1"
    assert ids(run_sql(spark, "SELECT id FROM items WHERE name = ?", [hostile])) == []
    assert ids(run_sql(spark, "SELECT id FROM items WHERE name = %s", [hostile], format_slots=True)) == []


def test_param_kinds(spark, items):
    row = run_sql(
        spark,
        "SELECT :d AS d, :f AS f, :b AS b, CAST(:n AS INT) AS n, array_contains(:l, 2) AS l",
        {"d": dt.date(2024, 1, 5), "f": 1.5, "b": True, "n": None, "l": [1, 2]},
    ).first()
    assert tuple(row) == (dt.date(2024, 1, 5), 1.5, True, None, True)


@pytest.mark.parametrize(("limit", "count"), [(None, 4), (0, 0), (2, 2), (100, 4)])
def test_limit(spark, items, limit, count):
    assert run_sql(spark, "SELECT * FROM items", limit=limit).count() == count


def test_negative_limit(spark, items):
    with pytest.raises(ValueError, match="negative"):
        run_sql(spark, "SELECT * FROM items", limit=-1)


def test_ordered_limit_is_top_k(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("orders")
    df = run_sql(spark, "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC", limit=3)
    assert "TakeOrderedAndProject" in executed_plan(df)


def test_partitions(spark, items):
    assert run_sql(spark, "SELECT * FROM items", partitions=5).rdd.getNumPartitions() == 5


def test_statements_other_than_queries(spark, db):
    run_sql(spark, f"CREATE TABLE {db}.a (x INT) USING parquet")
    run_sql(spark, f"INSERT INTO {db}.a VALUES (1), (2)")
    run_sql(spark, f"ALTER TABLE {db}.a RENAME TO {db}.b")
    assert run_sql(spark, f"SELECT sum(x) AS s FROM {db}.b").first().s == 3
    run_sql(spark, f"DROP TABLE {db}.b")
    with pytest.raises(AnalysisException):
        run_sql(spark, f"SELECT * FROM {db}.b")


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
    df = run_sql(spark, "SELECT user_id FROM events WHERE value > :v", {"v": 50.0})
    plan = executed_plan(df)
    assert "GreaterThan(value,50.0)" in plan
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_result_schema_runs_no_job_on_the_data(spark):
    failing = spark.range(1).select(F.raise_error(F.lit("read")).cast("int").alias("a"), F.array(F.lit(1)).alias("b"))
    assert [tuple(r) for r in result_schema(failing).collect()] == [
        (0, "a", "int"),
        (1, "b", "array<int>"),
    ]


def test_pandas_result(spark, items):
    frame = run_sql_pandas(
        spark,
        "SELECT id, DATE'2024-01-05' AS d, TIMESTAMP_NTZ'2024-01-05 10:00:00' AS t FROM items WHERE id < %s",
        [3],
        parse_dates=True,
        columns=["key", "day", "moment"],
        index_col="key",
        format_slots=True,
    )
    assert list(frame.columns) == ["day", "moment"]
    assert str(frame.dtypes["day"]) == str(frame.dtypes["moment"]) == "datetime64[ns]"
    assert len(frame) == 2
    typed = run_sql_pandas(spark, "SELECT id FROM items", dtype="float64")
    assert str(typed.dtypes["id"]) == "float64"
    assert run_sql_pandas(spark, "SELECT id FROM items", limit=2).shape == (2, 1)


def test_cast_temporal(spark):
    text = spark.createDataFrame(
        [("2024-01-05", "2024-01-05 10:00:00.5", 1), (None, None, 2)], "d string, t string, n int"
    )
    typed = cast_temporal(text, {"d": "date", "t": "timestamp"})
    assert typed.schema.simpleString() == "struct<d:date,t:timestamp_ntz,n:int>"
    assert tuple(typed.first()) == (dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 10, 0, 0, 500000), 1)
    assert typed.where("n = 2").first().d is None
    empty = cast_temporal(text.limit(0), {"d": "date"})
    assert empty.schema["d"].dataType.simpleString() == "date"
    with pytest.raises(ValueError, match="No such column"):
        cast_temporal(text, {"x": "date"})
    assert not python_nodes(typed)


def test_cast_temporal_bad_text(spark):
    text = spark.createDataFrame([("soon",), ("2024-01-05",)], "d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_temporal(text, {"d": "date"}).collect()
    lenient = cast_temporal(text, {"d": "date"}, lenient=True)
    assert [r.d for r in lenient.collect()] == [None, dt.date(2024, 1, 5)]


def test_cast_temporal_with_format(spark):
    text = spark.createDataFrame([("05/01/2024",), ("x",)], "d string")
    lenient = cast_temporal(text, {"d": "date"}, lenient=True, formats={"d": "dd/MM/yyyy"})
    assert [r.d for r in lenient.collect()] == [dt.date(2024, 1, 5), None]


def test_apply_schema(spark):
    df = spark.createDataFrame([("Ann", "34", "1990-02-01")], "a string, b string, c string")
    people = apply_schema(df, {"name": "varchar", "age": "integer", "birth_date": "date"})
    assert people.schema.simpleString() == "struct<name:string,age:int,birth_date:date>"
    assert tuple(people.first()) == ("Ann", 34, dt.date(1990, 2, 1))
    assert apply_schema(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(ValueError, match="2 columns, the data has 3"):
        apply_schema(df, "a int, b int")
    with pytest.raises(ValueError, match="2 names for 3"):
        apply_schema(df, ["a", "b"])


def test_apply_schema_with_repeated_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS a")
    assert tuple(apply_schema(df, {"x": "bigint", "y": "varchar"}).first()) == (1, "2")


def test_schema_of_a_result(spark, items):
    df = run_sql(spark, "SELECT id, name FROM items", schema={"k": "double", "label": "varchar"})
    assert df.schema.simpleString() == "struct<k:double,label:string>"


def test_null_tokens(spark):
    df = spark.createDataFrame(
        [("NULL", 1.0, 1), ("NaN", float("nan"), 2), ("null", None, 3), (None, 2.0, 4), ("nullable", 3.0, 5)],
        "s string, x double, i int",
    )
    clean = normalize_nulls(df).orderBy("i").collect()
    assert [r.s for r in clean] == [None, None, None, None, "nullable"]
    assert [r.x for r in clean] == [1.0, None, None, 2.0, 3.0]
    only_s = normalize_nulls(df, tokens=["n/a", "null"], cols=["s"]).orderBy("i").collect()
    assert [r.s for r in only_s] == [None, "NaN", None, None, "nullable"]
    assert only_s[1].x != only_s[1].x
    assert normalize_nulls(df, tokens=()).where("s = 'NULL'").count() == 1
    assert not python_nodes(normalize_nulls(df))
    with pytest.raises(ValueError, match="No such column"):
        normalize_nulls(df, cols=["nope"])


def test_column_functions_take_a_stream(spark, sf_dir, tmp_path):
    folder = tmp_path / "events"
    spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("string").alias("ts"), F.lit("null").alias("s")
    ).write.parquet(str(folder))
    stream = spark.readStream.schema("event_id bigint, ts string, s string").parquet(str(folder))
    shaped = apply_schema(normalize_nulls(cast_temporal(stream, {"ts": "timestamp"})), ["id", "ts", "s"])
    query = (
        shaped.writeStream.format("memory").queryName("shaped").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.sql("SELECT count(id) AS n, count(s) AS s, count(ts) AS t FROM shaped").first()[:] == (1000, 0, 1000)
