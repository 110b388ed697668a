"""Exact dedup by Grace hash partitioning.

Equal texts are found by comparing complete contents, never by a hash alone:

1. Every input task groups the texts it reads in an open-addressing table and passes on one
   record for each distinct text, so a text that a third of all rows share leaves a task once.
2. Spark's shuffle partitions these records by a hash of the content.
3. Each task loads its partition into such a table. What does not fit the memory given goes to
   spill files by further bits of the hash, and each file is treated in the same way, until it
   fits. Copies of one text take the space of one, so any number of copies fits.

Texts are equal when identical after lower-casing A-Z. A null text is empty. Of equal rows the
one with the largest id stays; a null id is smaller than any other; of rows equal in both one
stays. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .shared import small_batches, written

#: Bytes of distinct text that a task holds before it passes groups on or spills.
MEMORY = 32 << 20
#: Spill files at each level, and the hash bits that choose one of them.
FANOUT_BITS = 4
#: Rows of an output batch, and bytes of text in one.
OUT_ROWS, OUT_BYTES = 4096, 8 << 20


class ContentTable:
    """Open addressing with linear probing; a key is a whole content, compared in full."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, content: bytes, h: int) -> tuple[int, bool]:
        """The content's number, and whether it is new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (k := slots[at]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return int(k), False
            at = (at + 1) & mask
        k = slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 120
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return int(k), True

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        slots = np.full(mask + 1, -1, np.int64)
        for k, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = k
        self.slots = slots


def normalized(text: str | None) -> bytes:
    """bytes.lower() changes A-Z alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def content_hash(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content)


def larger(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a > b)


def _batches(columns: dict[str, list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if columns[schema.names[0]]:
        yield pa.RecordBatch.from_pydict(columns, schema=schema)
        for values in columns.values():
            values.clear()


def _local_groups(memory: int, schema: pa.Schema, text_col: str, with_ids: bool):
    """Step 1. Rows (id, row) to one row per distinct text of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = (TaskContext.get().partitionId() + 1) << 36
        seen, rows = ContentTable(), []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first
            out: dict[str, list] = {name: [] for name in schema.names}
            held = 0
            for k, (winner, best, ids, count, row) in enumerate(rows):
                out["gid"].append(first + k)
                out["h64"].append(struct.unpack("<q", struct.pack("<Q", seen.hashes[k]))[0])
                out["best"].append(best)
                out["n"].append(count)
                out["row"].append(row)
                if with_ids:
                    out["ids"].append(ids)
                    out["winner"].append(winner)
                held += len(seen.contents[k])
                if len(out["gid"]) >= OUT_ROWS or held >= OUT_BYTES:
                    held = 0
                    yield from _batches(out, schema)
            yield from _batches(out, schema)
            first += len(rows)

        kept = 0
        for batch in batches:
            ids, row_column = batch.column("id").to_pylist(), batch.column("row")
            texts = row_column.field(text_col).to_pylist()
            for i, (key, text) in enumerate(zip(ids, texts, strict=True)):
                content = normalized(text)
                k, new = seen.find(content, content_hash(content))
                if new:
                    rows.append([0, key, [key] if with_ids else None, 1, row_column[i].as_py()])
                    continue
                group = rows[k]
                group[3] += 1
                if with_ids:
                    group[2].append(key)
                    kept += 40
                if larger(key, group[1]):
                    group[0], group[1] = group[3] - 1, key
                    group[4] = row_column[i].as_py()
                if seen.bytes + kept > memory:
                    yield from flush()
                    seen, rows, kept = ContentTable(), [], 0
            if 2 * seen.bytes + kept > memory:
                yield from flush()
                seen, rows, kept = ContentTable(), [], 0
        yield from flush()

    return run


class _Spill:
    """Records of one bucket in a file of the task's own folder."""

    def __init__(self, folder: str, name: str) -> None:
        self.path = os.path.join(folder, name)
        self.file = open(self.path, "wb")  # noqa: SIM115  closed by read()

    def add(self, record: tuple[int, int, int | None, int, bytes, bytes]) -> None:
        h, gid, best, n, content, row = record
        self.file.write(
            struct.pack(
                "<QqqqBII", h, gid, best or 0, n, best is not None, len(content), len(row)
            )
        )
        self.file.write(content)
        self.file.write(row)

    def read(self) -> Iterator[tuple[int, int, int | None, int, bytes, bytes]]:
        self.file.close()
        head = struct.Struct("<QqqqBII")
        with open(self.path, "rb") as file:
            while data := file.read(head.size):
                h, gid, best, n, known, size, row = head.unpack(data)
                yield h, gid, best if known else None, n, file.read(size), file.read(row)
        os.unlink(self.path)


def grace(records, memory: int, folder: str, level: int = 0, name: str = "b") -> Iterator[tuple]:
    """Step 3: classes (content, [gid..], winner's gid, best id, count, winner's row) of records.

    Tries to hold the distinct contents in one table; beyond `memory` all of it, and what follows,
    goes to spill files by the next hash bits, which are then treated one after the other.
    """
    seen, classes, held = ContentTable(), [], 0
    spills: list[_Spill] | None = None
    shift = 64 - FANOUT_BITS * (level + 1)

    def put(record) -> None:
        spills[(record[0] >> max(shift, 0)) & ((1 << FANOUT_BITS) - 1)].add(record)

    for record in records:
        h, gid, best, n, content, row = record
        if spills is not None:
            put(record)
            continue
        k, new = seen.find(content, h)
        if new:
            classes.append([[gid], gid, best, n, row])
            held += len(row)
        else:
            group = classes[k]
            group[0].append(gid)
            group[3] += n
            if n and (larger(best, group[2]) or (best == group[2] and gid > group[1])):
                held += len(row) - len(group[4])
                group[1], group[2], group[4] = gid, best, row
        held += 40
        if seen.bytes + held > memory and len(seen.contents) > 1 and shift >= 0:
            spills = [_Spill(folder, f"{name}{i:x}") for i in range(1 << FANOUT_BITS)]
            for k, (gids, winner, best, n, row) in enumerate(classes):
                # the winner goes first and carries what the class has so far; n is 0 for the rest
                for gid in [winner, *(g for g in gids if g != winner)]:
                    won = gid == winner
                    put(
                        (
                            seen.hashes[k],
                            gid,
                            best if won else None,
                            n if won else 0,
                            seen.contents[k],
                            row if won else b"",
                        )
                    )
            seen, classes, held = ContentTable(), [], 0
    for k, (gids, winner, best, n, row) in enumerate(classes):
        yield seen.contents[k], gids, winner, best, n, row
    for i, spill in enumerate(spills or ()):
        yield from grace(spill.read(), memory, folder, level + 1, f"{name}{i:x}")


def _verdicts(memory: int, schema: pa.Schema, text_col: str):
    """Steps 2 and 3 for the report: one row per gid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("gid", "best", "n")]
                texts = batch.column("row").field(text_col).to_pylist()
                for gid, best, n, text in zip(*columns, texts, strict=True):
                    content = normalized(text)
                    yield content_hash(content), gid, best, n, content, b""

        out: dict[str, list] = {name: [] for name in schema.names}
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            for content, gids, winner, best, n, _ in grace(records(), memory, folder):
                digest = hashlib.sha256(content).hexdigest()
                for gid in gids:
                    for name, value in zip(
                        schema.names, (gid, best, n, gid == winner, digest), strict=True
                    ):
                        out[name].append(value)
                    if len(out["gid"]) >= OUT_ROWS:
                        yield from _batches(out, schema)
            yield from _batches(out, schema)

    return run


def _winners(memory: int, schema: pa.Schema, text_col: str):
    """Steps 2 and 3 for the rows that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = schema.field("row").type

        def records():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("gid", "best", "n")]
                rows = batch.column("row")
                texts = rows.field(text_col).to_pylist()
                for i, (gid, best, n, text) in enumerate(zip(*columns, texts, strict=True)):
                    content = normalized(text)
                    one = pa.RecordBatch.from_arrays([rows.slice(i, 1)], names=["row"])
                    yield (
                        content_hash(content), gid, best, n, content,
                        one.serialize().to_pybytes(),
                    )

        head = pa.schema([pa.field("row", kind)])
        held, size = [], 0
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            for content, _, _, _, _, row in grace(records(), memory, folder):
                held.append(pa.ipc.read_record_batch(pa.py_buffer(row), head))
                size += len(content)
                if len(held) >= OUT_ROWS or size >= OUT_BYTES:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def _grouped(df: DataFrame, id_col: str, text_col: str, memory: int, with_ids: bool) -> DataFrame:
    small_batches()
    row = df.columns if not with_ids else [text_col]
    source = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"),
    )
    fields = [
        T.StructField("gid", T.LongType()),
        T.StructField("h64", T.LongType()),
        T.StructField("best", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("row", source.schema["row"].dataType),
    ]
    if with_ids:
        fields += [
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("winner", T.IntegerType()),
        ]
    out = T.StructType(fields)
    return source.mapInArrow(_local_groups(memory, to_arrow_schema(out), text_col, with_ids), out)


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the lowered text)."""
    local = written(_grouped(df, id_col, text_col, memory, True), "exact")
    out = T.StructType.fromDDL(
        "gid long, keep_id long, group_size long, stays boolean, text_sha256 string"
    )
    verdicts = (
        local.select("gid", "h64", "best", "n", "row")
        .repartition("h64")
        .drop("h64")
        .mapInArrow(_verdicts(memory, to_arrow_schema(out), text_col), out)
    )
    return (
        local.select("gid", "ids", "winner")
        .join(verdicts, "gid")
        .select("*", F.posexplode("ids").alias("at", "id"))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("stays") & (F.col("at") == F.col("winner"))).alias("kept"),
            "text_sha256",
        )
    )


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY
) -> DataFrame:
    """The rows that stay, with all their columns."""
    local = _grouped(df, id_col, text_col, memory, False)
    out = T.StructType([T.StructField("row", local.schema["row"].dataType)])
    kept = (
        local.select("gid", "h64", "best", "n", "row")
        .repartition("h64")
        .drop("h64")
        .mapInArrow(_winners(memory, to_arrow_schema(out), text_col), out)
    )
    return kept.select("row.*")
