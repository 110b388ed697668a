"""SimHash near-dedup with a byte-position inverted index and count filtering.

A fingerprint is 64 bits: bit b is set if it is set in over half the hashes of the document's
word shingles. Fingerprints of at most `distance` = 2 differing bits are linked. Two differing
bits touch at most two of the eight bytes, so linked fingerprints share at least 8 - 2 = 6 bytes
at their positions: that is the guaranteed minimum. The index lists fingerprints by positional
bytes, four positions at a time (two of the four 16-bit halves of each word of the fingerprint:
a list by one position would hold 1/256 of everything). Two differing bits leave at least two
halves whole, so every linked pair meets in one of the six lists. In a list of few fingerprints
the pairs are formed, their shared positional bytes tallied, those below the minimum dropped, and
the rest verified by counting bits. A pair counts only in the first list both stand in.

A list of more than `SHORT` fingerprints, as thousands of near copies make, would give pairs
with the square of its length. Its fingerprints share the four bytes, and differ in at most two
of the other 32 bits exactly if flipping at most one of those 32 bits in each can make them
equal. So each gives its 33 variants, and whatever has a variant in common is linked to the
least: the same links, in proportion to the length.

Only distinct fingerprints are in the index; copies share one. Null and empty texts, and texts of
white space, have fingerprint zero and are linked like any other. Texts of fewer words than a
shingle are one shingle. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import small_batches, written

WORDS, DISTANCE, HASH_SEED = 3, 2, 42
#: Fingerprints of a list of which all pairs are formed.
SHORT = 16
BYTES = 8
#: Bits added up at once: bounds memory on very long texts.
BLOCK = 1 << 16


def text_fingerprint(text: str | None, words: int = WORDS, seed: int = HASH_SEED) -> int:
    """The fingerprint as a signed 64-bit number. bytes.lower and bytes.split are ASCII only."""
    cut = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not cut:
        return 0
    if len(cut) <= words:
        digests = [xxhash.xxh64_digest(b" ".join(cut), seed)]
    else:
        # words stand one space apart in `line`, so a shingle is a slice of it
        line = b" ".join(cut)
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_digest
        digests = [
            digest(line[a:b], seed)
            for a, b in zip(
                starts[: len(cut) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True
            )
        ]
    rows = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, BYTES)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), BLOCK):
        counts += np.unpackbits(rows[at : at + BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(rows))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """Column of fingerprints, as longs."""

    small_batches()

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t, words) for t in texts], dtype="int64")

    return of(text)


def _halves(fp: Column) -> list[Column]:
    """The four 16-bit halves: pairs of byte positions."""
    return [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]


def shared_bytes(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    differing = a.bitwiseXOR(b)
    tally = F.lit(0)
    for i in range(BYTES):
        same = F.shiftrightunsigned(differing, 8 * i).bitwiseAND(F.lit(0xFF)) == 0
        tally = tally + same.cast("int")
    return tally


def links(fps: DataFrame, distance: int = DISTANCE, short: int = SHORT) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints `fp` exactly as links of `distance` do."""
    if distance != 2:
        raise ValueError("the lists guarantee a meeting for two differing bits")
    tables = list(combinations(range(4), 2))
    fp = F.col("fp")
    halves = _halves(fp)
    index = fps.select(
        fp,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("t"),
                        F.shiftleft(halves[i], 16).bitwiseOR(halves[j]).alias("key"),
                    )
                    for t, (i, j) in enumerate(tables)
                ]
            )
        ),
    )
    sizes = (
        index.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ).select(F.col("t").alias("st"), F.col("key").alias("skey"), "n")
    listed = written(
        index.join(sizes, (F.col("t") == F.col("st")) & (F.col("key") == F.col("skey"))).select(
            "t", "key", "n", "fp"
        ),
        "postings",
    )
    few = listed.where(F.col("n") <= short)
    left = few.select("t", "key", F.col("fp").alias("a"))
    right = few.select(F.col("t").alias("rt"), F.col("key").alias("rkey"), F.col("fp").alias("b"))
    first = F.lit(len(tables))
    pair_halves = list(zip(_halves(F.col("a")), _halves(F.col("b")), strict=True))
    for t, (i, j) in reversed(list(enumerate(tables))):
        both = (pair_halves[i][0] == pair_halves[i][1]) & (pair_halves[j][0] == pair_halves[j][1])
        first = F.when(both, F.lit(t)).otherwise(first)
    pairs = (
        left.join(
            right,
            (F.col("t") == F.col("rt")) & (F.col("key") == F.col("rkey")) & (F.col("a") < F.col("b")),
        )
        .where(shared_bytes(F.col("a"), F.col("b")) >= BYTES - distance)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .where(F.col("t") == first)
        .select("a", "b")
    )
    variants = []
    for t, (i, j) in enumerate(tables):
        free = [16 * h + k for h in range(4) if h not in (i, j) for k in range(16)]
        masks = [0] + [(1 << b) - (1 << 64) * (b == 63) for b in free]
        variants.append(F.when(F.col("t") == t, F.array(*[F.lit(m).cast("long") for m in masks])))
    many = listed.where(F.col("n") > short).select(
        "t", "fp", F.explode(F.coalesce(*variants)).alias("mask")
    ).select("t", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp")
    least = many.groupBy("t", "point").agg(
        F.min("fp").alias("least"), F.count(F.lit(1)).alias("k")
    ).where("k > 1").select(F.col("t").alias("lt"), F.col("point").alias("lp"), "least")
    stars = many.join(
        least, (F.col("t") == F.col("lt")) & (F.col("point") == F.col("lp"))
    ).where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars.distinct())


def fingerprint_classes(fps: DataFrame) -> DataFrame:
    """(fp, best) over (fp, best) with distinct fp: best is the least of the whole component."""
    found = components(links(fps.select("fp")))
    named = fps.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "best", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("best").alias("least")).select(
        F.col("component").alias("c"), "least"
    )
    return named.join(least, F.col("component") == F.col("c")).select(
        "fp", F.col("least").alias("best")
    )


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links, null if all are null.
    """
    docs = written(
        df.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            fingerprint(F.col(f"`{text_col}`"), words).alias("fp"),
        ),
        "fingerprints",
    )
    fps = docs.groupBy("fp").agg(F.min("id").alias("best"))
    classes = fingerprint_classes(fps).select(F.col("fp").alias("cfp"), "best")
    return docs.join(classes, F.col("fp") == F.col("cfp")).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best").alias("component_id"),
    )


def simhash_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """The rows of the smallest id of each component, one for each, with all their columns.

    Rows get a number when they are written; it stands in for the id in the last join, so that
    repeated and null ids keep one row as well (null after all others).
    """
    docs = written(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("id"),
            fingerprint(F.col(f"`{text_col}`"), words).alias("fp"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "fingerprinted",
    )
    order = F.struct(F.col("id").isNull().alias("unknown"), F.col("id"), F.col("number"))
    fps = docs.groupBy("fp").agg(F.min(order).alias("best"))
    kept = fingerprint_classes(fps).select(F.col("best.number").alias("kept")).distinct()
    return docs.join(kept, F.col("number") == F.col("kept"), "left_semi").select("row.*")
