"""Embedding near-dedup by an epsilon grid order join.

Vectors of one label are linked if their cosine is at least the threshold; for unit vectors that
is a distance of at most eps = sqrt(2 - 2 * threshold). Projections on orthonormal directions
never lengthen a distance, so vectors (or boxes of vectors) further apart than eps on the leading
principal directions can't be linked.

1. Vectors are packed, in single precision where that loses nothing, and copies become one, with
   their number. A digest of 128 bits over label and vector tells them; rows keep only that.
2. The principal directions come from the sum of outer products over all vectors.
3. Vectors are sorted by label and by the cells, of side eps, they fall into on the leading
   directions: the epsilon grid order. The sorted sequence is cut into blocks of bounded size,
   so a label with a third of all rows is many blocks.
4. Intervals of the sequence are joined recursively: a pair of intervals is dropped if their
   boxes are further apart than eps, else replaced by the pairs of their 16 parts each, down to
   blocks. Boxes are joined by the interval above, so no pair is formed that was dropped above.
5. Pairs of blocks are joined in tasks, by tiles of a few neighbours, so that a block is sent
   once to a tile and not to every pair. There they are joined in the same way down to a few hundred vectors, and then
   by a product of matrices in double precision. Each task returns, per vector, how many it is
   linked to, and one representative of what its links connect, never all pairs.
6. Counts are added up, and components found over the representatives.

Every input row gives one row. Null labels, and vectors that are null, empty, zero or hold null
or non-finite parts, link with nothing; vectors of different length neither. Repeated rows link
with each other like different ones. Rows with a null id count as links; a component's id is the
smallest that is not null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import written

THRESHOLD = 0.93
#: Leading principal directions, and vectors in a block and in a product of matrices.
DIRECTIONS, BLOCK, LEAF = 8, 2048, 256
#: Lengths of vectors that get directions; rarer ones are joined without, which is exact too.
LENGTHS = 1000
#: Intervals above the blocks have 2 ** FAN parts.
FAN = 4
#: Tiles of pairs of blocks have 2 ** TILE blocks on a side.
TILE = 2
#: Added to distances in comparisons, against rounding; pairs are decided by their cosine alone.
SLACK = 1e-6


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Each row at length 1; scaled first, so that squares stay finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def comparable(label: Column, vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce(
        label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def packed(vectors: np.ndarray) -> list[bytes]:
    """Each row as bytes: four for a number where all of the row are exact so, else eight."""
    vectors = vectors + 0.0  # minus zero is zero
    with np.errstate(over="ignore"):
        narrow = vectors.astype(np.float32)
    exact = (narrow == vectors).all(axis=1)
    return [(n if e else v).tobytes() for n, v, e in zip(narrow, vectors, exact, strict=True)]


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    """What `packed` packed, in double precision."""
    out = np.empty((len(rows), dim))
    wide = np.array([len(r) == 8 * dim for r in rows], bool)
    for of_kind, kind in ((wide, np.float64), (~wide, np.float32)):
        data = b"".join(r for r, mine in zip(rows, of_kind.tolist(), strict=True) if mine)
        out[of_kind] = np.frombuffer(data, kind).reshape(-1, dim)
    return out


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packs vectors and gives each a digest; both are null where the vector is."""
    for frame in frames:
        out = frame[["id", "no_id", "label"]].copy()
        out["dim"], out["digest"], out["vec"] = 0, None, None
        sizes = frame["vector"].map(lambda v: 0 if v is None else len(v))
        for dim, part in frame[sizes > 0].groupby(sizes[sizes > 0]):
            rows = packed(np.stack(part["vector"].to_numpy()).astype(np.float64))
            labels = [label.encode() for label in part["label"]]
            out.loc[part.index, "dim"] = int(dim)
            out.loc[part.index, "vec"] = pd.Series(rows, part.index, object)
            out.loc[part.index, "digest"] = pd.Series(
                [
                    hashlib.blake2b(b"%d:%d:" % (dim, len(x)) + x + r, digest_size=16).digest()
                    for x, r in zip(labels, rows, strict=True)
                ],
                part.index,
                object,
            )
        yield out


def principal_directions(reps: DataFrame, k: int) -> dict[int, np.ndarray]:
    """For each length of vectors the k leading directions, as columns."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                units = unit_rows(unpacked(part["vec"].tolist(), int(dim)))
                sums[dim] = sums.get(dim, 0) + units.T @ units
        for dim, total in sums.items():
            i, j = np.triu_indices(dim)
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "s": total[i, j]})

    common = (
        reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).select("dim")
    )
    sums = (
        reps.join(F.broadcast(common), "dim", "left_semi")
        .select("dim", "vec")
        .mapInPandas(partial, "dim int, i int, j int, s double")
        .groupBy("dim", "i", "j")
        .agg(F.sum("s").alias("s"))
    )

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        dim = int(frame["dim"].iloc[0])
        total = np.zeros((dim, dim))
        total[frame["i"], frame["j"]] = frame["s"]
        total = total + np.triu(total, 1).T
        _, vectors = np.linalg.eigh(total)
        return pd.DataFrame({"dim": [dim], "axes": [vectors[:, ::-1][:, :k].tobytes()]})

    found = sums.groupBy("dim").applyInPandas(solve, "dim int, axes binary").collect()
    return {r["dim"]: np.frombuffer(r["axes"]).reshape(r["dim"], -1) for r in found}


def _places(units: np.ndarray, axes: dict[int, np.ndarray], k: int) -> np.ndarray:
    """Coordinates on the leading directions; zeros where there are none."""
    places = np.zeros((len(units), k))
    if units.shape[1] in axes:
        there = units @ axes[units.shape[1]]
        places[:, : there.shape[1]] = there
    return places


def _placed(axes, eps: float, k: int) -> Callable:
    """Adds the cells that vectors fall into, as bytes that sort like the numbers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                places = _places(unit_rows(unpacked(part["vec"].tolist(), int(dim))), axes.value, k)
                cells = np.clip(np.floor(places / max(eps, SLACK)), -(2**31), 2**31 - 1) + 2**31
                yield part[["rep", "label", "dim", "n", "vec"]].assign(
                    cells=[c.tobytes() for c in cells.astype(">u4")]
                )

    return run


def _blocks(axes, k: int, block: int) -> Callable:
    """Cuts the sorted rows of a task into blocks of one label and length."""

    def row(pid: int, seq: int, rows: list[pd.DataFrame]) -> dict:
        part = pd.concat(rows)
        dim, vecs = int(part["dim"].iloc[0]), part["vec"].tolist()
        vectors = unpacked(vecs, dim)
        place = _places(unit_rows(vectors), axes.value, k)
        narrow = all(len(v) == 4 * dim for v in vecs)
        return {
            "label": part["label"].iloc[0],
            "dim": dim,
            "pid": pid,
            "seq": seq,
            **{f"lo{i}": place[:, i].min() for i in range(k)},
            **{f"hi{i}": place[:, i].max() for i in range(k)},
            "reps": part["rep"].to_numpy(np.int64).tobytes(),
            "counts": part["n"].to_numpy(np.float64).tobytes(),
            "vecs": b"".join(vecs) if narrow else vectors.tobytes(),
        }

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, seq = TaskContext.get().partitionId(), 0
        held, size, key = [], 0, None
        for frame in frames:
            change = (frame["label"] != frame["label"].shift()) | (
                frame["dim"] != frame["dim"].shift()
            )
            for _, run_ in frame.groupby(change.cumsum(), sort=False):
                own = (run_["label"].iloc[0], run_["dim"].iloc[0])
                at = 0
                while at < len(run_):
                    if held and (own != key or size == block):
                        yield pd.DataFrame([row(pid, seq, held)])
                        held, size, seq = [], 0, seq + 1
                    key = own
                    part = run_.iloc[at : at + block - size]
                    held.append(part)
                    size += len(part)
                    at += len(part)
        if held:
            yield pd.DataFrame([row(pid, seq, held)])

    return run


def _levels(max_seq: int, max_pid: int) -> list[tuple[int, int]]:
    """Shifts (of seq, of pid) that make the intervals, from blocks to the whole of a label."""
    levels = [(0, 0)]
    while max_seq >> levels[-1][0]:
        levels.append((levels[-1][0] + FAN, 0))
    while max_pid >> levels[-1][1]:
        levels.append((levels[-1][0], levels[-1][1] + FAN))
    return levels


def block_pairs(boxes: DataFrame, k: int, eps: float) -> DataFrame:
    """Pairs (label, dim, a_pid, a_seq, b_pid, b_seq) of blocks that may hold links, each once, a <= b."""
    ends = boxes.agg(F.max("seq"), F.max("pid")).first()
    levels = _levels(ends[0] or 0, ends[1] or 0)
    sides = [f"{e}{i}" for e in ("lo", "hi") for i in range(k)]

    def intervals(level: tuple[int, int]) -> DataFrame:
        return boxes.groupBy(
            "label",
            "dim",
            F.shiftright("pid", level[1]).alias("pid"),
            F.shiftright("seq", level[0]).alias("seq"),
        ).agg(
            *[F.min(f"lo{i}").alias(f"lo{i}") for i in range(k)],
            *[F.max(f"hi{i}").alias(f"hi{i}") for i in range(k)],
        )

    apart = F.lit(0.0)
    for i in range(k):
        gap = F.greatest(
            F.lit(0.0),
            F.col(f"a_lo{i}") - F.col(f"b_hi{i}"),
            F.col(f"b_lo{i}") - F.col(f"a_hi{i}"),
        )
        apart = apart + gap * gap
    near = apart <= (eps + SLACK) ** 2
    top = intervals(levels[-1])
    pairs = top.select(
        "label", "dim",
        *[F.col(c).alias(f"{s}_{c}") for s in "ab" for c in ("pid", "seq")],
    )
    for upper, lower in zip(levels[:0:-1], levels[-2::-1], strict=True):
        parts = intervals(lower)

        def side(s: str, parts=parts, upper=upper, lower=lower) -> DataFrame:
            return parts.select(
                F.col("label").alias(f"{s}_label"),
                F.col("dim").alias(f"{s}_dim"),
                F.shiftright("pid", upper[1] - lower[1]).alias(f"{s}_up_pid"),
                F.shiftright("seq", upper[0] - lower[0]).alias(f"{s}_up_seq"),
                F.col("pid").alias(f"{s}_pid_"),
                F.col("seq").alias(f"{s}_seq_"),
                *[F.col(c).alias(f"{s}_{c}") for c in sides],
            )

        for s in "ab":
            pairs = pairs.join(
                side(s),
                (F.col("label") == F.col(f"{s}_label"))
                & (F.col("dim") == F.col(f"{s}_dim"))
                & (F.col(f"{s}_pid") == F.col(f"{s}_up_pid"))
                & (F.col(f"{s}_seq") == F.col(f"{s}_up_seq")),
            )
        ordered = F.struct("a_pid_", "a_seq_") <= F.struct("b_pid_", "b_seq_")
        pairs = pairs.where(ordered & near).select(
            "label", "dim",
            *[F.col(f"{s}_{c}_").alias(f"{s}_{c}") for s in "ab" for c in ("pid", "seq")],
        )
    return pairs


class _Join:
    """Links between two blocks, or within one."""

    def __init__(self, blocks: list[dict], same: bool, threshold: float, eps: float, leaf: int):
        self.blocks, self.same, self.threshold, self.leaf = blocks, same, threshold, leaf
        self.reach = (eps + SLACK) ** 2
        first = len(blocks[0]["reps"])
        self.base = (0, 0 if same else first)
        size = first if same else first + len(blocks[1]["reps"])
        self.parent = list(range(size))
        self.links = np.zeros(size)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def run(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        """Joins interval a of the first block with interval b of the last."""
        if self.same and a > b:
            return
        one, two = self.blocks[0], self.blocks[-1]
        pa, pb = one["places"][slice(*a)], two["places"][slice(*b)]
        gap = np.maximum(0, np.maximum(pa.min(0) - pb.max(0), pb.min(0) - pa.max(0)))
        if (gap * gap).sum() > self.reach:
            return
        if max(a[1] - a[0], b[1] - b[0]) > self.leaf:
            for x in _cut(a, self.leaf):
                for y in _cut(b, self.leaf):
                    self.run(x, y)
            return
        linked = one["units"][slice(*a)] @ two["units"][slice(*b)].T >= self.threshold
        twice = self.same and a == b
        if twice:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        ia, ib = a[0] + self.base[0], b[0] + self.base[1]
        self.links[ia : ia + len(linked)] += linked @ two["counts"][slice(*b)]
        if not twice:
            self.links[ib : ib + linked.shape[1]] += linked.T @ one["counts"][slice(*a)]
        # a row connects its first partner with itself and with all its other partners
        first = linked.argmax(1)
        rows = np.flatnonzero(linked.any(1))
        for i, j in zip(rows.tolist(), first[rows].tolist(), strict=True):
            self.union(ia + i, ib + j)
        i, j = np.nonzero(linked)
        for code in np.unique(first[i] * linked.shape[1] + j).tolist():
            self.union(ib + code // linked.shape[1], ib + code % linked.shape[1])


def _cut(interval: tuple[int, int], leaf: int) -> list[tuple[int, int]]:
    """Both halves, at a multiple of `leaf`, or the interval if it is a leaf."""
    start, stop = interval
    if stop - start <= leaf:
        return [interval]
    middle = start + max(1, (stop - start) // leaf // 2) * leaf
    return [(start, middle), (middle, stop)]


def _joined(axes, threshold: float, eps: float, k: int, leaf: int) -> Callable:
    """Joins the blocks of a tile; those that don't meet are left by their boxes at once."""

    def loaded(r: pd.Series) -> dict:
        reps, dim = np.frombuffer(r["reps"], np.int64), int(r["dim"])
        width = len(r["vecs"]) // len(reps)
        rows = [r["vecs"][i : i + width] for i in range(0, len(r["vecs"]), width)]
        units = unit_rows(unpacked(rows, dim))
        return {
            "reps": reps,
            "counts": np.frombuffer(r["counts"]),
            "places": _places(units, axes.value, k),
            "units": units,
        }

    def linked(blocks: list[dict]) -> pd.DataFrame:
        join = _Join(blocks, len(blocks) == 1, threshold, eps, leaf)
        join.run((0, len(blocks[0]["reps"])), (0, len(blocks[-1]["reps"])))
        reps = np.concatenate([b["reps"] for b in blocks])
        hit = np.flatnonzero(join.links)
        roots = np.array([join.find(i) for i in hit.tolist()], np.int64)
        return pd.DataFrame(
            {
                "rep": reps[hit],
                "links": join.links[hit].astype(np.int64),
                "root": reps[roots] if len(roots) else roots,
            }
        )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        at = frame.iloc[0]
        blocks = {(r["pid"], r["seq"]): loaded(r) for _, r in frame.iterrows()}

        def side(s: str) -> list[tuple[int, int]]:
            tile = (at[f"{s}_pid"], at[f"{s}_tile"])
            return sorted(b for b in blocks if (b[0], b[1] >> TILE) == tile)

        return pd.concat(
            [
                linked([blocks[x]] if x == y else [blocks[x], blocks[y]])
                for x in side("a")
                for y in side("b")
                if x <= y
            ]
        )

    return run


def embedding_groups(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    directions: int = DIRECTIONS,
    block: int = BLOCK,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept (id = component_id)."""
    spark = df.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    k = directions
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    usable = comparable(F.col("label"), F.col("vector"))
    # pandas has no null among whole numbers, and would make them inexact
    slim = written(
        rows.select(
            F.coalesce("id", F.lit(0)).alias("id"),
            F.col("id").isNull().alias("no_id"),
            "label",
            F.when(usable, F.col("vector")).alias("vector"),
        )
        .mapInPandas(
            _packed, "id long, no_id boolean, label string, dim int, digest binary, vec binary"
        )
        .select(F.expr("if(no_id, null, id)").alias("id"), "label", "dim", "digest", "vec"),
        "packed",
    )
    reps = written(
        slim.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("id").alias("best"),
            *[F.first(c).alias(c) for c in ("label", "dim", "vec")],
        )
        .select("*", F.monotonically_increasing_id().alias("rep")),
        "vectors",
    )
    axes = spark.sparkContext.broadcast(principal_directions(reps, k))
    placed = reps.select("rep", "label", "dim", "n", "vec").mapInPandas(
        _placed(axes, eps, k),
        "rep long, label string, dim int, n long, vec binary, cells binary",
    )
    order = ["label", "dim", "cells", "rep"]
    blocks = written(
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(
            _blocks(axes, k, block),
            "label string, dim int, pid long, seq long, "
            + ", ".join(f"{e}{i} double" for e in ("lo", "hi") for i in range(k))
            + ", reps binary, counts binary, vecs binary",
        ),
        "blocks",
    )
    pairs = block_pairs(blocks.drop("reps", "counts", "vecs"), k, eps)
    tile = ["a_pid", "a_tile", "b_pid", "b_tile"]
    sides = pairs.select(
        F.col("label").alias("of_label"),
        F.col("dim").alias("of_dim"),
        *["a_pid", F.shiftright("a_seq", TILE).alias("a_tile")],
        *["b_pid", F.shiftright("b_seq", TILE).alias("b_tile")],
        F.inline(
            F.array(
                F.struct(F.col("a_pid").alias("p"), F.col("a_seq").alias("s")),
                F.struct(F.col("b_pid").alias("p"), F.col("b_seq").alias("s")),
            )
        ),
    ).distinct()
    loaded = sides.join(
        blocks.select("dim", "pid", "seq", "reps", "counts", "vecs"),
        (F.col("p") == F.col("pid")) & (F.col("s") == F.col("seq")),
    ).drop("p", "s")
    found = written(
        loaded.groupBy("of_label", "of_dim", *tile).applyInPandas(
            _joined(axes, threshold, eps, k, leaf), "rep long, links long, root long"
        ),
        "links",
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (
        reps.select("rep", "digest", "n", "best")
        .join(counts.withColumnRenamed("rep", "rep_c"), F.col("rep") == F.col("rep_c"), "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            "best",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    least = named.groupBy("component").agg(F.min("best").alias("least")).select(
        F.col("component").alias("c"), "least"
    )
    named = named.join(least, F.col("component") == F.col("c")).select(
        F.col("digest").alias("d"), "n_links", "least"
    )
    return slim.select("id", "digest").join(named, F.col("digest") == F.col("d"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("least", "id"), F.lit(False)).alias("kept"),
    )
