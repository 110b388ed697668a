import pytest
from pyspark.sql import types as T

from tableops import spark_type
from tableops.functions.types import struct_from, struct_of


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("integer", T.IntegerType()),
        ("BIGINT", T.LongType()),
        ("boolean", T.BooleanType()),
        ("double", T.DoubleType()),
        ("real", T.FloatType()),
        ("smallint", T.ShortType()),
        ("varchar", T.StringType()),
        ("varchar(10)", T.StringType()),
        ("char(3)", T.StringType()),
        ("varbinary", T.BinaryType()),
        ("date", T.DateType()),
        ("timestamp", T.TimestampNTZType()),
        ("timestamp with time zone", T.TimestampType()),
        ("timestamp_ltz", T.TimestampType()),
        ("timestamp_ntz", T.TimestampNTZType()),
        ("decimal", T.DecimalType(38, 18)),
        ("decimal(5,2)", T.DecimalType(5, 2)),
        ("array(bigint)", T.ArrayType(T.LongType())),
        ("array<varchar(5)>", T.ArrayType(T.StringType())),
        ("array(array(bigint))", T.ArrayType(T.ArrayType(T.LongType()))),
        ("array(decimal(5,2))", T.ArrayType(T.DecimalType(5, 2))),
        ("map(varchar, double)", T.MapType(T.StringType(), T.DoubleType())),
        (
            "map(varchar(3), array(decimal(5, 2)))",
            T.MapType(T.StringType(), T.ArrayType(T.DecimalType(5, 2))),
        ),
        ("map<string,decimal>", T.MapType(T.StringType(), T.DecimalType(38, 18))),
        ("struct<a:integer>", T.StructType([T.StructField("a", T.IntegerType())])),
    ],
)
def test_type_names(spark, name, expected):
    assert spark_type(name) == expected


@pytest.mark.parametrize("name", ["nonsense", "array(nonsense)", "expression", "", "array("])
def test_unknown_type_name(spark, name):
    with pytest.raises(ValueError, match="Unknown type name"):
        spark_type(name)


def test_unknown_type_names_its_column(spark):
    with pytest.raises(ValueError, match="'age'"):
        struct_of({"name": "varchar", "age": "years"})


def test_schema_forms_agree(spark):
    by_dict = struct_of({"name": "varchar", "age": "integer", "birth_date": "date"})
    assert by_dict == struct_of("name string, age int, birth_date date")
    assert by_dict == struct_from(["name", "age", "birth_date"], ["varchar", "integer", "date"])
    assert struct_of(by_dict) is by_dict
    with pytest.raises(ValueError, match="2 column names but 1"):
        struct_from(["a", "b"], ["varchar"])
