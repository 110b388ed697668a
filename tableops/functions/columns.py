"""Projections over whole frames: schema, temporal casts, NULL tokens, result metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType

from tableops.functions.names import quoted
from tableops.functions.types import spark_type, struct_of

# Texts that stand for NULL, compared in lower case.
NULL_TOKENS = ("null", "nan")


def apply_schema(
    df: DataFrame, schema: StructType | str | Mapping[str, str | DataType] | list[str]
) -> DataFrame:
    """Rename by position and, unless only names are given, cast to the schema's types.

    A value that does not fit its type fails the job (ANSI).
    """
    if isinstance(schema, (list, tuple)):
        if len(schema) != len(df.columns):
            raise ValueError(f"{len(schema)} names for {len(df.columns)} columns")
        return df.toDF(*schema)
    schema = struct_of(schema)
    if len(schema) != len(df.columns):
        raise ValueError(f"Schema has {len(schema)} columns, the data has {len(df.columns)}")
    # By-position names first, so that repeated column names in the input do no harm.
    slots = [f"c{i}" for i in range(len(schema))]
    return df.toDF(*slots).select(
        *[F.col(slot).cast(f.dataType).alias(f.name) for slot, f in zip(slots, schema)]
    )


def cast_temporal(
    df: DataFrame,
    cols: Mapping[str, str],
    lenient: bool = False,
    formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """Turn date and timestamp text into real types, all in one projection.

    ``cols`` maps a column to ``date`` or ``timestamp`` (without zone). Text that is
    no date fails the job, or becomes NULL when ``lenient``.
    """
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"No such column: {', '.join(missing)}")
    formats = formats or {}

    def parsed(name: str) -> Column:
        kind, source = spark_type(cols[name]), F.col(quoted(name))
        if name in formats:
            # without zone all the way, so that the session's zone moves no clock time
            pattern = F.lit(formats[name])
            parsed_text = F.to_timestamp_ntz(source, pattern)
            if lenient:
                is_time = F.try_to_timestamp(source, pattern).isNotNull()
                parsed_text = F.when(is_time, parsed_text)
            source = parsed_text
        cast = source.try_cast(kind) if lenient else source.cast(kind)
        return cast.alias(name)

    return df.select(*[parsed(c) if c in cols else F.col(quoted(c)) for c in df.columns])


def null_token_column(
    name: str, kind: DataType, tokens: Iterable[str] = NULL_TOKENS
) -> Column:
    """The column with NULL tokens (and, for the token 'nan', float NaN) made NULL."""
    column, tokens = F.col(quoted(name)), [t.lower() for t in tokens]
    if isinstance(kind, StringType) and tokens:
        return F.when(~F.lower(column).isin(tokens), column).alias(name)
    if isinstance(kind, (FloatType, DoubleType)) and "nan" in tokens:
        return F.when(~F.isnan(column), column).alias(name)
    return column


def normalize_nulls(
    df: DataFrame, tokens: Iterable[str] = NULL_TOKENS, cols: Iterable[str] | None = None
) -> DataFrame:
    """Make the tokens NULL in the given columns (all columns by default)."""
    tokens = tuple(tokens)
    chosen = set(df.columns if cols is None else cols)
    missing = chosen - set(df.columns)
    if missing:
        raise ValueError(f"No such column: {', '.join(sorted(missing))}")
    return df.select(
        *[
            null_token_column(f.name, f.dataType, tokens)
            if f.name in chosen
            else F.col(quoted(f.name))
            for f in df.schema
        ]
    )


def result_schema(df: DataFrame) -> DataFrame:
    """Position, name and type of each column of a result. Runs no job on the data."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)],
        "pos int, col_name string, col_type string",
    )
