"""Type names to Spark types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql.types import DataType, StructField, StructType

# Type names that Spark spells otherwise, as pattern -> Spark name.
# A timestamp without zone is Spark's timestamp_ntz, and a decimal without
# precision keeps 18 fraction digits where Spark's own default would keep none.
TYPE_NAMES = {
    r"varchar(\s*\(\s*\d+\s*\))?": "string",
    r"char(\s*\(\s*\d+\s*\))?": "string",
    r"integer": "int",
    r"real": "float",
    r"varbinary": "binary",
    r"decimal(?!\s*\()": "decimal(38,18)",
    r"timestamp\s+with\s+time\s+zone": "timestamp_ltz",
    r"timestamp(?!\s+with)": "timestamp_ntz",
}

# Containers without element types, as the element types they then have.
BARE_CONTAINERS = {
    r"\barray\b(?!\s*[<(])": "array<string>",
    r"\bmap\b(?!\s*[<(])": "map<string,string>",
}

_TOKENS = re.compile(r"`(?:[^`]|``)*`|\w+|\s+|.", re.DOTALL)
_BRACKETS = re.compile(r"\b(array|map)\s*\(((?:[^()]|decimal\s*\([^()]*\))*)\)")


def _names_aside(text: str) -> tuple[str, list[str]]:
    """The text with the field names of structs replaced by numbers, and the names as written."""
    out, names, open_, word, name_next = [], [], [], "", False
    for token in _TOKENS.findall(text):
        if name_next and not token.isspace():
            name_next = False
            if token[0] == "`" or token[0].isalnum() or token[0] == "_":
                out.append(f"\x01{len(names)}\x01")
                names.append(token if token[0] == "`" else f"`{token}`")
                continue
        if token in "<(":
            open_.append(token == "<" and word == "struct")
            name_next = open_[-1]
        elif token in ">)":
            open_ = open_[:-1]
        elif token == ",":
            name_next = bool(open_) and open_[-1]
        if not token.isspace():
            word = token.lower()
        out.append(token)
    return "".join(out), names


def spark_type(name: str) -> DataType:
    """The Spark type for a type name such as ``varchar(10)`` or ``map(varchar, array(bigint))``.

    Any name Spark's own DDL takes is accepted too. Field names of structs stay as they are.
    A bare ``array`` has string elements, a bare ``map`` string keys and values.
    """
    text, names = _names_aside(name.strip())
    text = text.lower()
    for pattern, spark_name in TYPE_NAMES.items():
        text = re.sub(rf"\b{pattern}(?![\w])", spark_name, text)
    for pattern, spark_name in BARE_CONTAINERS.items():
        text = re.sub(pattern, spark_name, text)
    replaced = 1
    while replaced:  # innermost brackets first, once per nesting level
        text, replaced = _BRACKETS.subn(r"\1<\2>", text)
    text = re.sub("\x01(\\d+)\x01", lambda m: names[int(m[1])], text)
    try:
        kind = DataType.fromDDL(text)
    except PySparkException as error:
        raise ValueError(f"Unknown type name: {name!r}") from error
    if isinstance(kind, StructType) and not text.startswith("struct"):
        raise ValueError(f"Unknown type name: {name!r}")  # columns, not a type
    return kind


def struct_of(schema: StructType | str | Mapping[str, str | DataType]) -> StructType:
    """A schema given as StructType, DDL text, or mapping of column name to type."""
    if isinstance(schema, StructType):
        return schema
    if isinstance(schema, str):
        return StructType.fromDDL(schema)
    return struct_from(schema.keys(), schema.values())


def struct_from(names: Iterable[str], types: Iterable[str | DataType]) -> StructType:
    """A schema from parallel names and types; an unknown type names its column."""
    names, types = list(names), list(types)
    if len(names) != len(types):
        raise ValueError(f"{len(names)} column names but {len(types)} column types")
    fields = []
    for name, kind in zip(names, types):
        try:
            fields.append(
                StructField(name, kind if isinstance(kind, DataType) else spark_type(kind))
            )
        except ValueError as error:
            raise ValueError(f"Column {name!r}: {error}") from error
    return StructType(fields)
