"""Orders rows along a space-filling curve, and tells whether a copy holds the same rows."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tableops.functions.names import quoted

#: Bits of a column's place on the curve, and columns that a curve takes.
BITS, COLUMNS = 8, 7


class CopyDiffers(RuntimeError):
    """A copy doesn't hold the rows of its source."""


def checksum(schema: StructType) -> list[Column]:
    """``rows`` and ``hashes``, a sum of row hashes: equal for the same rows in any order."""
    columns = []
    for field in schema:
        column = F.col(quoted(field.name))
        # Spark doesn't hash maps; a copy keeps the order of their entries
        shown = F.to_json(column) if "map<" in field.dataType.simpleString() else column
        columns += [shown, column.isNull()]
    hashes = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(hashes, F.lit(0)).alias("hashes")]


def require_same(expected: dict[str, Any], found: dict[str, Any], name: str) -> None:
    if any(expected[k] != found[k] for k in ("rows", "hashes")):
        raise CopyDiffers(
            f"The copy of {name} has {found['rows']} rows with checksum {found['hashes']}, not"
            f" {expected['rows']} with {expected['hashes']}"
        )


def number_of(column: Column, kind: DataType) -> Column:
    """A double that rises with the value; of text, with its first six bytes."""
    if isinstance(kind, NumericType | BooleanType):
        return (column.cast("int") if isinstance(kind, BooleanType) else column).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        digits = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    raise ValueError(f"No order along a curve for type {kind.simpleString()}")


def curve(df: DataFrame, by: list[str]) -> tuple[Column, dict[str, Any]]:
    """The place of a row on the curve through ``by``, and the frame's checksum.

    One scan gives both. A column's values are cut into 256 ranges at approximate quantiles, so
    that skewed values spread too; the bits of the ranges' numbers are interleaved. NULL is in
    the first range.
    """
    if not 0 < len(by) <= COLUMNS or len({c.lower() for c in by}) < len(by):
        raise ValueError(f"One to {COLUMNS} different columns make a curve: {by}")
    kinds = {c: df.select(F.col(quoted(c))).schema[0].dataType for c in by}
    numbers = [number_of(F.col(quoted(c)), kinds[c]) for c in by]
    shares = [i / 2**BITS for i in range(1, 2**BITS)]
    seen = df.agg(
        *[F.percentile_approx(n, shares, 10_000).alias(f"q{i}") for i, n in enumerate(numbers)],
        *checksum(df.schema),
    ).first().asDict()
    place = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        bounds = F.array(*[F.lit(float(b)) for b in seen[f"q{i}"] or shares])
        place = place + _spread(_rank(number, bounds), len(by), i)
    return place, seen


def _rank(number: Column, bounds: Column) -> Column:
    """How many of the sorted bounds lie below the number: a binary search."""
    return F.aggregate(
        F.array(*[F.lit(1 << b) for b in reversed(range(BITS))]),
        F.lit(0),
        lambda low, step: F.when(F.get(bounds, low + step - 1) < number, low + step).otherwise(low),
    ).cast("long")


def _spread(rank: Column, step: int, offset: int) -> Column:
    """The bits of a rank, `step` apart; as a lambda's argument the rank is worked out once."""

    def bits(r: Column) -> Column:
        moved = [
            F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")), b * step + offset)
            for b in range(BITS)
        ]
        return reduce(Column.__add__, moved)

    return F.get(F.transform(F.array(rank), bits), F.lit(0))
