"""Best-fit packing of tokenized documents into sequences of a fixed length, by bin completion.

A document is its token ids and an end id. Only documents longer than a sequence are cut, into
full pieces behind a first piece that holds the rest; full pieces fill a sequence alone. How the
other pieces go together depends on their lengths only, so the search (`bin_completion`) works on
a histogram of at most `capacity` rows, whatever the number of documents: its plan says how many
sequences hold which lengths. Every piece finds its place in the plan by its rank among the pieces
of its length: pieces are counted by task and length, so that no length, however frequent, comes
together in one task, and neither texts nor ids are shuffled.

The ids are those of the tokenizers library for a byte-level BPE definition (its JSON file) with
add_special_tokens=False and text that spells a special token taken as text. They are worked out by
tiktoken from the same vocabulary, which gives equal ids in a quarter of the time; definitions for
which that does not hold are refused. The definition is broadcast; its size is checked.

Null and empty texts are the end id alone. Ids may be null or repeat: each row is a document of
its own. Equal lengths are told apart by their place in the input. An empty table gives no pieces.
Columns other than the id and the text are ignored, so their names can't clash. A text is encoded
whole, and its ids are held once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bin_completion import Plan, pack
from .byte_bpe import byte_characters
from .shared import small_batches, written

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 1024, 2
#: Largest definition that is broadcast, in characters.
LARGEST = 256 << 20

PIECES = (
    "doc_id long, piece int, start long, length long, ids binary, task int, nth long"
)


def byte_level_definition(path: str) -> str:
    """The JSON of a tokenizer that tiktoken can stand in for; others are refused."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if len(text) > LARGEST:
        raise ValueError("the vocabulary is too large to broadcast")
    made = json.loads(text)
    model, before = made["model"], made.get("pre_tokenizer") or {}
    vocabulary = model["vocab"]
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if not (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not made.get("normalizer")
        and all(vocabulary.get(c) is not None for c in byte_characters())
        and all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merged))
    ):
        raise ValueError(f"{path} is no byte-level BPE whose merges are ranked by id")
    return text


@lru_cache(maxsize=1)
def _encoding(definition: str, pattern: str):
    """One for all tasks of a Python worker."""
    import tiktoken

    back = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = json.loads(definition)["model"]["vocab"]
    ranks = {bytes(back[c] for c in token): rank for token, rank in vocabulary.items()}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


class BestFitPacker:
    """Pieces of documents, their places in sequences, and the sequences.

    `pattern` is the byte-level pattern that splits text before merges.
    """

    def __init__(
        self, spark: SparkSession, path: str, pattern: str, capacity: int = CAPACITY, end: int = END
    ) -> None:
        if capacity < 1:
            raise ValueError("a sequence holds at least one token")
        small_batches()
        self.capacity, self.end, self.pattern = capacity, end, pattern
        self._definition = spark.sparkContext.broadcast(byte_level_definition(path))

    def pieces(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """A row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32 bits),
        and task and nth, by which the piece is ranked among those of its length."""
        shared, capacity, end, pattern = self._definition, self.capacity, self.end, self.pattern

        def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            met = np.zeros(capacity + 1, np.int64)
            encode = _encoding(shared.value, pattern).encode_to_numpy
            closing = np.array([end], "<u4")
            for batch in batches:
                rows: list[list] = [[] for _ in range(6)]
                for id_, text_ in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                    ids = encode(text_, disallowed_special=()).astype("<u4") if text_ else closing[:0]
                    ids = np.concatenate([ids, closing])
                    for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                        row = id_, piece, start, length, ids[start : start + length].tobytes(), met[length]
                        for column, value in zip(rows, row, strict=True):
                            column.append(value)
                        met[length] += 1
                kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()
                made = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
                made.insert(5, pa.array([task] * len(rows[0]), pa.int32()))
                names = ["doc_id", "piece", "start", "length", "ids", "task", "nth"]
                yield pa.RecordBatch.from_arrays(made, names=names)

        read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        return read.mapInArrow(cut_up, PIECES)

    def placed(self, pieces: DataFrame) -> DataFrame:
        """The pieces with sequence_id and offset instead of task and nth.

        `pieces` must be a table that is read the same way twice (`shared.written`), not a plan
        that is run again; it may lack ids or have further columns.
        """
        counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("pieces_met"))
        counts = written(counts, "packing")
        by_length = {
            r["length"]: r["n"]
            for r in counts.groupBy("length").agg(F.sum("pieces_met").alias("n")).collect()
        }
        plan = self.plan(by_length)
        before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(
            F.col("task").alias("in_task"),
            F.col("length").alias("of_length"),
            F.coalesce(F.sum("pieces_met").over(before), F.lit(0)).alias("met_before"),
        )
        joined = pieces.join(
            offsets, (F.col("task") == F.col("in_task")) & (F.col("length") == F.col("of_length"))
        )
        place = places(plan)(F.col("length"), F.col("nth") + F.col("met_before"))
        added = ("task", "nth", "in_task", "of_length", "met_before")
        found = joined.withColumn("place", place)
        kept = [c for c in pieces.columns if c not in added]
        return found.select(
            *kept,
            F.col("place.sequence_id").alias("sequence_id"),
            F.col("place.offset").alias("offset"),
        )

    def plan(self, by_length: dict[int, int]) -> Plan:
        """How many sequences hold which lengths; `by_length` has at most `capacity` entries."""
        counts = [0] * (self.capacity + 1)
        for length, n in by_length.items():
            counts[length] = n
        full, counts[self.capacity] = counts[self.capacity], 0
        alone: Plan = [(full, ((self.capacity, 1),))] if full else []
        return alone + pack(counts, self.capacity)

    def sequences(self, placed: DataFrame) -> DataFrame:
        """sequence_id and its ids as binary, from placed pieces that kept their ids."""
        parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
        whole = F.reduce(
            parts, F.lit(b""), lambda joined, part: F.concat(joined, part.getField("ids"))
        )
        return placed.groupBy("sequence_id").agg(whole.alias("ids"))


def places(plan: Plan):
    """A function of (length, rank among the pieces of that length): sequence and offset.

    Ranks go through the plan in order; a part of the plan that holds a length `each` times in
    each of its sequences takes the next ranks, `each` to a sequence.
    """
    segments, sequence = [], 0
    taken: dict[int, int] = {}
    for bins, fill in plan:
        offset = 0
        for size, each in fill:
            segments.append((size, taken.get(size, 0), sequence, each, offset))
            taken[size] = taken.get(size, 0) + bins * each
            offset += size * each
        sequence += bins
    segments.sort()
    size, first, start, each, base = (
        np.array(c, np.int64) for c in (zip(*segments, strict=True) if segments else [[]] * 5)
    )
    # lengths are at most the capacity, ranks are below 2 to the power of 40
    keys = (size << 40) + first

    @F.pandas_udf("sequence_id long, offset long")
    def of(length, rank):
        import pandas as pd

        wanted, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(keys, (wanted << 40) + rank, "right") - 1
        t = rank - first[at]
        return pd.DataFrame(
            {"sequence_id": start[at] + t // each[at], "offset": base[at] + t % each[at] * wanted}
        )

    return of


def packed_pieces(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of documents."""
    packer = BestFitPacker(docs.sparkSession, path, pattern, capacity, end)
    cut: Column = F.crc32("ids").alias("ids_crc32")
    rows = packer.pieces(docs).select("doc_id", "piece", "start", "length", cut, "task", "nth")
    return packer.placed(written(rows, "pieces"))
