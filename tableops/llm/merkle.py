"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep hash states.

Each row is a leaf. The leaves of a source, by id, make a tree in which every three neighbours
have a parent, the digest of their hex digests one after the other; the subroots of all sources,
by source, make another, whose root stands for the whole dataset. A parent keeps a copy of its hash
state before each child's place. To fold a changed leaf, the state before its place is resumed with
the new digest and the siblings to the right; those to the left are in the state already.

Trees are cut into blocks of 729 neighbours (six levels), so that no task holds a source. Blocks
are raised to their roots, those again, until each tree has one node. On the way down each block
hands its members their ladder: the siblings left and right of them on every level above. A task
makes the states of a block's parents and of its ladder once and copies them for every leaf.
Positions come from a range sort that is written once; equal rows are told apart by their place in
the input, so a repeated id is spread like any other. Nothing is collected but the largest size of a tree.

Fields that are null are written `-`, others as UTF-8 byte count, `:`, value, so texts may be
empty, very long or hold any character. Ids that are null come first, and rows with equal ids are
ordered by digest. Null is a source of its own and comes first. An empty table has no rows.
Other columns are ignored, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import written

#: Children of a parent; levels in a block.
ARITY, LEVELS = 3, 6
BLOCK = ARITY**LEVELS
#: Bits below a task's number in Spark's increasing ids.
TASK_BITS = 33

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_KEY = "tree_null boolean, tree string"


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex digest of a row's fields in the order of FIELDS."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(columns[c]) for c in FIELDS]).cast("binary"), 256)


def height(n: int) -> int:
    """Levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def raised(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from the given ones up."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append(
            [_sha("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)]
        )
    return found


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Parent:
    """Hash states before each child's place, and what stands left and right of it."""

    __slots__ = ("left", "right", "states")

    def __init__(self, children: list[str]) -> None:
        state = hashlib.sha256()
        self.states, self.left, self.right = [], [], []
        for slot, child in enumerate(children):
            self.states.append(state.copy())
            self.left.append("".join(children[:slot]))
            self.right.append("".join(children[slot + 1 :]))
            state.update(child.encode())

    def folded(self, slot: int, digest: str) -> str:
        """The parent's digest with another child in the slot."""
        state = self.states[slot].copy()
        state.update((digest + self.right[slot]).encode())
        return state.hexdigest()


class Rung:
    """One level of a ladder: the state behind all left siblings, kept for every fold."""

    __slots__ = ("state", "siblings", "right")

    def __init__(self, left: str, right: str) -> None:
        self.state, self.right, self.siblings = hashlib.sha256(left.encode()), right, left + right

    def folded(self, digest: str) -> str:
        state = self.state.copy()
        state.update((digest + self.right).encode())
        return state.hexdigest()


def rungs(ladder: str) -> list[Rung]:
    """A ladder is `left|right` of each level, from below, joined by `;`."""
    return [Rung(*level.split("|")) for level in ladder.split(";")] if ladder else []


def parents_of(levels: list[list[str]]) -> list[list[Parent]]:
    return [
        [Parent(below[i : i + ARITY]) for i in range(0, len(below), ARITY)] for below in levels[:-1]
    ]


def positions(rows: DataFrame, tree: Column, order: list[Column]) -> DataFrame:
    """The rows with tree_null, tree, pos (from 0 within the tree) and total, written.

    `order` must tell all rows apart.
    """
    keyed = rows.withColumns({"tree_null": tree.isNull(), "tree": F.coalesce(tree, F.lit(""))})
    by = [F.col("tree_null").desc(), F.col("tree"), *order]
    number = F.monotonically_increasing_id()
    listed = written(
        keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("number", number), "order"
    )
    task, place = F.shiftright("number", TASK_BITS), F.col("number").bitwiseAND((1 << TASK_BITS) - 1)
    runs = listed.groupBy("tree_null", "tree", task.alias("task")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    )
    whole = Window.partitionBy("tree_null", "tree")
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col("tree_null").alias("of_null"), F.col("tree").alias("of_tree"),
        F.col("task").alias("of_task"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(whole).alias("total"),
    )
    same = (
        (F.col("tree_null") == F.col("of_null"))
        & (F.col("tree") == F.col("of_tree"))
        & (task == F.col("of_task"))
    )
    return written(
        listed.join(offsets, same)
        .withColumn("pos", place - F.col("first") + F.col("offset"))
        .drop("number", "first", "offset", "of_null", "of_tree", "of_task"),
        "nodes",
    )


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).alias("block")


def raise_trees(nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every sixth level, from the given ones to the roots: tree, pos, digest, total."""

    def raise_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = int(rows["total"].iat[0])
        digests = rows.sort_values("pos")["digest"].tolist()
        root = raised(digests, min(LEVELS, height(total)))[-1][0]
        return pd.DataFrame([(*key, root, -(-total // BLOCK))], columns=names)

    names = ["tree_null", "tree", "pos", "digest", "total"]
    stages = [nodes.select(*names)]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        blocks = stages[-1].groupBy("tree_null", "tree", _block())
        schema = f"{_KEY}, pos long, digest string, total long"
        stages.append(written(blocks.applyInPandas(raise_block, schema), "blocks"))
        most = -(-most // BLOCK)
    return stages


def lower_ladders(
    stages: list[DataFrame], top: DataFrame, extra: list[str], kinds: str
) -> DataFrame:
    """Ladders (tree, pos, ladder, and `extra` columns) of the nodes of `stages[0]`.

    `top` has the ladders of the roots, which are the nodes of the last stage.
    """
    names = ["tree_null", "tree", "pos", "ladder", *extra]

    def lower(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = raised(rows["digest"].tolist(), min(LEVELS, height(int(rows["total"].iat[0]))))
        parents, carried = parents_of(levels), above["ladder"].iat[0]
        shared = [above[c].iat[0] for c in extra]
        out = []
        for i, pos in enumerate(rows["pos"].tolist()):
            path, at = [], i
            for level in parents:
                parent, slot = level[at // ARITY], at % ARITY
                path.append(f"{parent.left[slot]}|{parent.right[slot]}")
                at //= ARITY
            ladder = ";".join([*path, carried] if carried else path)
            out.append((*key[:2], pos, ladder, *shared))
        return pd.DataFrame(out, columns=names)

    ladders = top
    for stage in reversed(stages[:-1]):
        blocks = stage.groupBy("tree_null", "tree", _block())
        above = ladders.withColumnRenamed("pos", "block").groupBy("tree_null", "tree", "block")
        schema = f"{_KEY}, pos long, ladder string{kinds}"
        ladders = written(blocks.cogroup(above).applyInPandas(lower, schema), "ladders")
    return ladders


def manifest(docs: DataFrame, change: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (digest of all siblings, level by level), changed
    (the leaf with `change` applied to its text), folded_root and verified, for every row.

    The changed leaf is folded with the siblings of the original.
    """
    columns = {c: F.col(c) for c in FIELDS}
    changed = columns if change is None else {**columns, "text": change(F.col("text"))}
    rows = written(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"),
            leaf_digest(columns).alias("digest"),
            leaf_digest(changed).alias("changed"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "leaves",
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("place")]
    leaves = positions(rows, F.col("source"), order)
    stages = raise_trees(leaves)

    # the tree over the subroots: one tree, its nodes in the order of the sources
    sources = stages[-1].select(
        F.col("tree_null").alias("source_null"), F.col("tree").alias("source_tree"), "digest"
    )
    by_source = [F.col("source_null").desc(), F.col("source_tree")]
    subroots = positions(sources, F.lit(""), by_source)
    over = raise_trees(subroots)
    root = over[-1].select(
        "tree_null", "tree", "pos", F.lit("").alias("ladder"), F.col("digest").alias("root")
    )
    found = lower_ladders(over, root, ["root"], ", root string")
    named = subroots.select(
        F.col("pos").alias("of_pos"), "source_null", "source_tree", F.col("digest").alias("subroot")
    )
    top = found.join(named, F.col("pos") == F.col("of_pos")).select(
        F.col("source_null").alias("tree_null"), F.col("source_tree").alias("tree"),
        F.lit(0).cast("long").alias("pos"), "ladder", "root", "subroot",
    )
    # ladders of the blocks of leaves; of a tree of one block, those of its root
    blocks = lower_ladders(stages[1:], top, ["root", "subroot"], ", root string, subroot string") if (
        len(stages) > 1
    ) else top

    def fold(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        digests = rows["digest"].tolist()
        levels = raised(digests, min(LEVELS, height(int(rows["total"].iat[0]))))
        parents, ladder = parents_of(levels), rungs(above["ladder"].iat[0])
        over = "".join(rung.siblings for rung in ladder)
        proofs, folded = [], []
        for i, digest in enumerate(rows["changed"].tolist()):
            at, siblings = i, []
            for level in parents:
                parent, slot = level[at // ARITY], at % ARITY
                siblings += (parent.left[slot], parent.right[slot])
                digest, at = parent.folded(slot, digest), at // ARITY
            for rung in ladder:
                digest = rung.folded(digest)
            proofs.append(_sha("".join(siblings) + over))
            folded.append(digest)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].astype("Int64"), "leaf": digests,
                "subroot": above["subroot"].iat[0], "root": above["root"].iat[0],
                "proof_sha256": proofs, "changed": rows["changed"], "folded_root": folded,
            }
        )

    members = leaves.groupBy("tree_null", "tree", _block())
    ladders = blocks.withColumnRenamed("pos", "block").groupBy("tree_null", "tree", "block")
    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
        " changed string, folded_root string"
    )
    folded = members.cogroup(ladders).applyInPandas(fold, schema)
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
