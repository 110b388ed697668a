"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, byte-level BPE.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows the stage before kept.
Rows may repeat, ids and texts may be null, and documents may have further columns, which pass
through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.llm.exact_dedup import exact_dedup
from tableops.llm.mixing import mix, word_count
from tableops.llm.queries import bpe_digests
from tableops.llm.shared import table, written
from tableops.llm.simhash import simhash_dedup
from tableops.llm.toxicity import THRESHOLD, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go."""
    score = toxicity(docs, table(spark, sf_dir, "labels"), F.col("text"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = docs.select(row.alias("row"), score.alias("score"))
    return scored.where(F.col("score") < THRESHOLD).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    The operator cuts a source at the exact word; a stage passes on whole texts, so the document
    at the cut counts once more if at least half of it lies before the cut.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = written(
        docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number")), "mixed"
    )
    plan = mix(
        numbered.select(
            F.col("row.doc_id").alias("doc_id"),
            F.col("row.source").alias("source"),
            word_count(F.col("row.text")).alias("size"),
            "number",
        )
    )
    last = F.greatest(F.lit(0), F.least("size", F.col("budget") - F.col("before")))
    times = F.col("epochs") + F.when((F.col("size") > 0) & (2 * last >= F.col("size")), 1).otherwise(0)
    copies = plan.select(F.col("number").alias("taken_number"), times.cast("int").alias("times"))
    return (
        numbered.join(
            copies.where("times > 0"), F.col("number") == F.col("taken_number")
        )
        .select("row", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one"))
        .select("row.*")
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of decoded bytes, one row per document taken."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("mixing", mixed),
    ("byte_bpe", encode),
]

#: SQL can't express a trained network, so the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
