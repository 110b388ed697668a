"""Input data to DataFrames: Spark, pandas-on-Spark, pandas, and rows held by the caller."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def is_frame(data: Any) -> bool:
    return isinstance(data, (DataFrame, pd.DataFrame)) or hasattr(data, "to_spark")


def as_frame(spark: SparkSession, data: Any, schema: StructType | None) -> DataFrame:
    """One DataFrame from whatever the caller holds.

    Rows come as lists or tuples and need a schema; their values travel as text and are
    cast to it later by Spark, so '5' and 5 are both good for a number, and a date may be
    a date or text. Bytes for a text column are read as UTF-8; a time with a zone is refused
    by a column without.
    """
    if isinstance(data, DataFrame):
        return data
    if hasattr(data, "to_spark"):
        return data.to_spark()
    if isinstance(data, pd.DataFrame):
        return spark.createDataFrame(data)
    if schema is None:
        raise ValueError("Rows need a schema: give column names and types")
    for row in data:
        if len(row) != len(schema):
            raise ValueError(f"A row has {len(row)} values, the schema {len(schema)} columns")
    text_schema = StructType([StructField(f.name, _text_type(f.dataType)) for f in schema])
    rows: Sequence[tuple] = [
        tuple(_as_text(v, f.dataType) for v, f in zip(row, schema)) for row in data
    ]
    return spark.createDataFrame(rows, text_schema)


def _text_type(kind: DataType) -> DataType:
    if isinstance(kind, ArrayType):
        return ArrayType(_text_type(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_text_type(kind.keyType), _text_type(kind.valueType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _text_type(f.dataType)) for f in kind])
    return kind if isinstance(kind, BinaryType) else StringType()


def _as_text(value: Any, kind: DataType) -> Any:
    if value is None or isinstance(kind, BinaryType):
        return value
    if isinstance(kind, ArrayType):
        return [_as_text(v, kind.elementType) for v in value]
    if isinstance(kind, MapType):
        return {
            _as_text(k, kind.keyType): _as_text(v, kind.valueType)
            for k, v in dict(value).items()
        }
    if isinstance(kind, StructType):
        return tuple(_as_text(v, f.dataType) for v, f in zip(value, kind))
    if isinstance(value, (bytes, bytearray)):
        return value.decode("utf-8")
    if isinstance(kind, TimestampNTZType) and getattr(value, "tzinfo", None) is not None:
        raise ValueError(f"The column has no time zone, the value has: {value}")
    return str(value)
