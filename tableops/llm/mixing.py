"""Mixing sources to target weights.

The sizes of all sources are shared out by weight. A source can give at most `max_epochs` times
what it has; what it cannot take goes to the others by weight, until none is above its limit.

Within a source documents stand in the order of a hash-random key (MD5 of seed and id, so reruns
agree). The key's leading bits are the range partition: they cut a source into ranges of about
`RANGE_ROWS` rows, as many as its size asks for, so a source with a third of all rows is many
ranges. Sizes are summed by range, then over the ranges before it, then within the range: a
distributed prefix sum. The ranges before are summed level by level, each of `LEVEL_DIGITS` digits
of the key, so that no task adds up more than 4,096 of them. A source takes whole epochs as long as its target lasts, and in the last
one the documents before the exact word at which the budget ends; the document there gives the
words still missing.

A null source is a source of its own, last in order. A null text has size 0. Documents equal in
key are ordered by id and size; rows equal in all are interchangeable. An empty table gives an
empty result; sources without words get nothing. Further columns pass through; one that is named
as an added column, in whatever case, gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, written

#: Rows of a source that one range holds, on average.
RANGE_ROWS = 2_000
#: Hex digits of the key in one level of the sums over ranges.
LEVEL_DIGITS = 3
SEED = "mix-1"
#: What `mix` adds.
ADDED = ("source_size", "target", "epochs", "before", "budget", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .., cycle and again, over the sources (one row each) by code point, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.select(
        "source", (F.pmod(F.row_number().over(by_name) - 1, F.lit(cycle)) + 1).alias("weight")
    )


def targets(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Adds `target` to (source, source_size, weight): the share of the total of all sizes.

    Sources in order of limit per weight: as long as an equal share per weight of what is left
    would be above a source's limit, it gets its limit. Sums are of whole numbers and so exact.
    """
    limit = F.col("source_size") * max_epochs
    ratio = F.when(F.col("weight") > 0, limit / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_limit").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(after)
    ranked = (
        sources.withColumns({"_limit": limit, "_ratio": ratio})
        .withColumn("_total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("_level", F.when(F.sum("weight").over(after) > 0, level))
    )
    # the first source that stays below its limit sets the level of all from there on
    first = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_rank", "_level"))).over(
        Window.partitionBy()
    )
    free = F.col("_rank") >= F.col("_first._rank")
    return (
        ranked.withColumn("_rank", F.row_number().over(order))
        .withColumn("_first", first)
        .withColumn(
            "target",
            F.when(F.coalesce(free, F.lit(False)), F.col("weight") * F.col("_first._level"))
            .otherwise(F.col("_limit").cast("double")),
        )
        .drop("_limit", "_ratio", "_total", "_level", "_rank", "_first")
    )


def range_starts(per_range: DataFrame, digits: int) -> DataFrame:
    """(start_source, start_range, start): the sum of range_size over the ranges of a source before it.

    `per_range` has one row per source and range, a prefix of the key of at most `digits` digits.
    Prefixes that share all but the last level are summed in a window; each begins where its
    parent does. A prefix shorter than a level is its own parent there.
    """
    starts = None
    for upto in range(LEVEL_DIGITS, max(digits, 1) + LEVEL_DIGITS, LEVEL_DIGITS):
        sizes = per_range.groupBy("source", F.left("range", F.lit(upto)).alias("range")).agg(
            F.sum("range_size").alias("size")
        )
        parent = F.left("range", F.lit(upto - LEVEL_DIGITS))
        siblings = Window.partitionBy("source", parent).orderBy("range")
        level = sizes.select(
            "source", "range", parent.alias("parent"),
            (F.sum("size").over(siblings) - F.col("size")).alias("start"),
        )
        if starts is not None:
            level = level.withColumnRenamed("start", "own").join(
                starts,
                F.col("source").eqNullSafe(F.col("start_source"))
                & (F.col("parent") == F.col("start_range")),
            ).withColumn("start", F.col("start") + F.col("own"))
        starts = level.select(
            F.col("source").alias("start_source"), F.col("range").alias("start_range"), "start"
        )
    return starts


def mix(
    sized: DataFrame,
    weights: DataFrame | None = None,
    max_epochs: int = 3,
    seed: str = SEED,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Over (doc_id, source, size, ..): adds source_size, target, epochs, before, budget, taken.

    epochs: how often the document is taken in full; before: words of its source that stand
    before it in the last epoch; budget: words that epoch takes; taken: words in all.
    `weights` has one row per source; without it they cycle. The input is read once and kept as
    a slim table, without texts; columns beside the three pass through.
    """
    more = [c for c in sized.columns if c.lower() not in ("doc_id", "source", "size", *ADDED)]
    sized = written(sized.select("doc_id", "source", "size", *[F.col(f"`{c}`") for c in more]), "mix")
    keyed = sized.select(
        "doc_id",
        "source",
        "size",
        F.struct(*[F.col(f"`{c}`") for c in more]).alias("more") if more else F.lit(None).alias("more"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
              .cast("binary")).alias("key"),
    )
    totals = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    if weights is None:
        weights = cycling_weights(totals.select("source"))
    given = weights.select(F.col("source").alias("given_source"), "weight")
    known = totals.join(given, F.col("source").eqNullSafe(F.col("given_source")), "left").select(
        "source",
        "source_size",
        "rows",
        F.coalesce(F.col("weight"), F.lit(0)).alias("weight"),
    )
    plan = written(
        targets(known, max_epochs)
        .withColumn("words", F.floor("target").cast("long"))
        .withColumn(
            "epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size")))
            .otherwise(0).cast("long"),
        )
        .withColumn("budget", F.col("words") - F.col("epochs") * F.col("source_size"))
        # a power of 16: the range is the leading hex digits of the key
        .withColumn(
            "digits",
            F.greatest(
                F.lit(0), F.ceil(F.log(16.0, F.greatest(F.col("rows") / range_rows, F.lit(1.0))))
            ).cast("int"),
        )
        .select(F.col("source").alias("plan_source"), "source_size", "target", "epochs", "budget",
                "digits"),
        "mix-plan",
    )
    digits = plan.agg(F.max("digits")).first()[0] or 0
    placed = keyed.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        "doc_id", "source", "size", "more", "key", "source_size", "target", "epochs", "budget",
        F.expr("left(key, digits)").alias("range"),
    )
    per_range = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    starts = range_starts(per_range, digits)
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    ranged = placed.join(
        starts,
        F.col("source").eqNullSafe(F.col("start_source"))
        & (F.col("range") == F.col("start_range")),
    )
    before = F.col("start") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranged.withColumn("before", before - F.col("size"))
        .withColumn(
            "taken",
            F.col("epochs") * F.col("size")
            + F.greatest(F.lit(0), F.least("size", F.col("budget") - F.col("before"))),
        )
        .select(
            "doc_id", "source", "size", "source_size", "target", "epochs", "before", "budget",
            "taken", *[F.col(f"more.`{c}`") for c in more],
        )
    )
