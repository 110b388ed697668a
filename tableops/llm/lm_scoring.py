"""LM scoring: cross-entropy difference of two matched word-bigram models.

A target corpus says what text is wanted; the documents are the background. Both models have one
vocabulary, all words of both corpora, one order and one smoothing:

    p(w | h) = (c(h, w) + MU * p(w)) / (c(h) + MU),   p(w) = (c(w) + 1) / (N + V)

and the score of a document is the mean over its tokens of ln p_background - ln p_target, negated:
the target's loss less the background's. Lower is more like the target.

Neither words nor bigrams are bounded, and neither are ever in one place:

1. Texts are put into blocks of about `BLOCK` tokens, written once: the block's words with their
   counts, and its tokens as places in that list.
2. Each block sends its words to buckets by hash. A bucket adds up the counts of its words, numbers
   them, and answers each block with numbers and totals, in the order of its words.
3. Each block numbers its bigrams and sends the distinct ones to buckets; these answer alike.
4. Each block scores its documents with the answers.

What is in all texts, word or bigram, is one entry per block, so nothing is hot. A number has 32
bits: the job fails, rather than leave words out, where a bucket has more words than these allow.

Words are runs of anything but ASCII white space, A-Z in lower case. The first word follows a
start mark. Null and empty texts have no tokens and score 0. Repeated rows count and score each.
Without a target all its counts are 0; an empty background gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cores, small_batches, written

#: Weight of the unigram model in the smoothing, in occurrences.
MU = 100.0
#: Tokens of a block, and of all blocks for each bucket of words or bigrams.
BLOCK, BUCKET = 1 << 20, 4_000_000
#: Number of the mark at the start of a text.
START = np.uint64(0xFFFFFFFF)

BLOCKS = (
    "block long, target boolean, doc_ids array<long>, lengths binary, words binary, n binary,"
    " contexts binary, tokens binary, size long, opened long"
)
WORDS = "bucket int, block long, target boolean, words binary, n binary, contexts binary"
#: What buckets answer: of words numbers and totals, of bigrams totals; `distinct` and the sums of
#: tokens and texts stand in one row of each bucket of words.
ANSWERS = (
    "kind string, bucket int, block long, numbers binary, background binary, goal binary,"
    " background_contexts binary, goal_contexts binary, distinct long, tokens long, goal_tokens long"
)
BIGRAMS = "bucket int, block long, target boolean, keys binary, n binary"


def words(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@lru_cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@lru_cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _packed(values: np.ndarray, kind: str = "<u4") -> bytes:
    """All first bytes of the numbers, all second ones, ..., compressed: most are zero."""
    raw = np.ascontiguousarray(values, kind)
    return _compressor().compress(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes())


def _ints(packed: bytes, kind: str = "<u4") -> np.ndarray:
    raw = np.frombuffer(_decompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _listed(own: list[bytes]) -> bytes:
    return _compressor().compress(b"\n".join(own))


def _list(packed: bytes) -> list[bytes]:
    raw = _decompressor().decompress(packed)
    return raw.split(b"\n") if raw else []


def _factorized(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return pd.factorize(np.array([*found, None], object)[:-1])


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first, number = TaskContext.get().partitionId() << 32, 0
    found, lengths, names, kind = [], [], [], None

    def block() -> pd.DataFrame:
        codes, unique = _factorized(found)
        n = np.bincount(codes, minlength=len(unique))
        # the most frequent first, so that most places are small numbers
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        codes, n = place[codes], n[order]
        sizes = np.array(lengths, np.int64)
        last = (np.cumsum(sizes) - 1)[sizes > 0]
        contexts = n - np.bincount(codes[last], minlength=len(n))
        row = (
            first + number, kind, names, _packed(sizes, "<i8"), _listed(unique[order].tolist()),
            _packed(n), _packed(contexts), _packed(codes), len(codes), len(last),
        )
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    for frame in frames:
        for name, text, target in zip(frame["doc_id"], frame["text"], frame["target"], strict=True):
            own = words(text)
            if lengths and (target != kind or len(found) + len(lengths) + len(own) > BLOCK):
                yield block()
                number += 1
                found, lengths, names = [], [], []
            kind = bool(target)
            found += own
            lengths.append(len(own))
            names.append(None if pd.isna(name) else int(name))
    if lengths:
        yield block()


def _split(at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings a bucket's entries together, as they are, and where each bucket begins."""
    order = np.argsort(at, kind="stable")
    return order, np.searchsorted(at[order], np.arange(buckets + 1))


def _filled(begins: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(begins)).tolist()


def _words_split(own: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return _split(np.fromiter((zlib.crc32(w) % buckets for w in own), np.int64, len(own)), buckets)


def _words_sent(buckets: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                own, n, contexts = _list(r.words), _ints(r.n), _ints(r.contexts)
                order, begins = _words_split(own, buckets)
                rows = []
                for b in _filled(begins):
                    at = order[begins[b] : begins[b + 1]]
                    listed = _listed([own[i] for i in at.tolist()])
                    rows.append((b, r.block, r.target, listed, _packed(n[at]), _packed(contexts[at])))
                if rows:
                    yield pd.DataFrame(rows, columns=["bucket", "block", "target", "words", "n", "contexts"])

    return run


def _words_answered(shift: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [_list(w) for w in frame["words"]]
        codes, unique = _factorized([w for own in lists for w in own])
        if len(unique) >= 1 << shift:
            raise ValueError("a bucket has more words than there are numbers")
        sizes = [len(own) for own in lists]
        target = np.repeat(frame["target"].to_numpy(bool), sizes)

        def totals(name: str) -> list[np.ndarray]:
            each = np.concatenate([_ints(x) for x in frame[name]]).astype(np.float64)
            sums = [np.bincount(codes, each * mask, len(unique)) for mask in (~target, target)]
            return [x.astype(np.uint64) for x in sums]

        n, contexts = totals("n"), totals("contexts")
        bucket = int(frame["bucket"].iat[0])
        numbers = (np.uint64(bucket) << np.uint64(shift)) | codes.astype(np.uint64)
        out, ends = [], np.cumsum(sizes)
        for row, (block, size, end) in enumerate(zip(frame["block"], sizes, ends, strict=True)):
            at = codes[end - size : end]
            sums = (len(unique), int(n[0].sum()), int(n[1].sum())) if not row else (0, 0, 0)
            out.append(
                ("words", bucket, block, _packed(numbers[end - size : end]),
                 *(_packed(x[at], "<u8") for x in (*n, *contexts)), *sums)
            )
        return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERS.split(", ")])

    return run


class _Known:
    """A block with the numbers and totals of its words."""

    def __init__(self, row: pd.Series, answers: pd.DataFrame, buckets: int) -> None:
        own = _list(row["words"])
        order, begins = _words_split(own, buckets)
        self.numbers = np.zeros(len(own), np.uint64)
        self.totals = np.zeros((4, len(own)))
        for a in answers[answers["kind"] == "words"].itertuples(index=False):
            at = order[begins[a.bucket] : begins[a.bucket + 1]]
            self.numbers[at] = _ints(a.numbers)
            for k, x in enumerate((a.background, a.goal, a.background_contexts, a.goal_contexts)):
                self.totals[k, at] = _ints(x, "<u8")
        self.sizes = _ints(row["lengths"], "<i8")
        self.tokens = _ints(row["tokens"]).astype(np.int64)
        # the context of each token: the one before, or the start of its text
        self.begins = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        word = self.numbers[self.tokens]
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[self.begins] = START
        self.keys = (context << np.uint64(32)) | word


def _bigrams_split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return _split(((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), buckets)


def _bigrams_sent(buckets: int):
    """Distinct bigrams of each block, ascending in each bucket, as steps from one to the next."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in blocks.iterrows():
            keys, n = np.unique(_Known(row, answers, buckets).keys, return_counts=True)
            order, begins = _bigrams_split(keys, buckets)
            for b in _filled(begins):
                at = order[begins[b] : begins[b + 1]]
                steps = np.diff(keys[at], prepend=np.uint64(0))
                out.append((b, row["block"], row["target"], _packed(steps, "<u8"), _packed(n[at])))
        return pd.DataFrame(out, columns=["bucket", "block", "target", "keys", "n"])

    return run


def _bigrams_answered(frame: pd.DataFrame) -> pd.DataFrame:
    """Totals of a bucket's bigrams, for each background block in the order of its keys."""
    lists = [np.cumsum(_ints(k, "<u8"), dtype=np.uint64) for k in frame["keys"]]
    sizes, keys = [len(k) for k in lists], np.concatenate(lists)
    n = np.concatenate([_ints(c) for c in frame["n"]]).astype(np.float64)
    target = np.repeat(frame["target"].to_numpy(bool), sizes)
    distinct, inverse = np.unique(keys, return_inverse=True)
    totals = [
        np.bincount(inverse, n * mask, len(distinct)).astype(np.uint64)[inverse]
        for mask in (~target, target)
    ]
    bucket, ends = int(frame["bucket"].iat[0]), np.cumsum(sizes)
    out = [
        ("bigrams", bucket, block, None, *(_packed(t[e - k : e], "<u8") for t in totals), None, None, 0, 0, 0)
        for block, is_target, k, e in zip(frame["block"], frame["target"], sizes, ends, strict=True)
        if not is_target
    ]
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERS.split(", ")])


def _scored(buckets: int, distinct: int, tokens: list[int], texts: list[int], mu: float):
    names = ["doc_id", "n_tokens", "target_loss", "background_loss"]

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in blocks.iterrows():
            if row["target"]:
                continue
            known = _Known(row, answers, buckets)
            keys, at, inverse = np.unique(known.keys, return_index=True, return_inverse=True)
            order, begins = _bigrams_split(keys, buckets)
            joint = np.zeros((2, len(keys)))
            for a in answers[answers["kind"] == "bigrams"].itertuples(index=False):
                own = order[begins[a.bucket] : begins[a.bucket + 1]]
                joint[0, own], joint[1, own] = _ints(a.background, "<u8"), _ints(a.goal, "<u8")
            word = known.tokens[at]
            opens = (keys >> np.uint64(32)) == START
            before = known.tokens[np.maximum(at - 1, 0)]
            losses = []
            for c in (0, 1):
                unigram = (known.totals[c][word] + 1) / (tokens[c] + distinct)
                context = np.where(opens, texts[c], known.totals[2 + c][before])
                each = -np.log((joint[c] + mu * unigram) / (context + mu))[inverse]
                sums = np.zeros(len(known.sizes))
                if len(each):
                    sums[known.sizes > 0] = np.add.reduceat(each, known.begins)
                losses.append(sums / np.maximum(known.sizes, 1))
            ids = [None if d is None or pd.isna(d) else int(d) for d in row["doc_ids"]]
            columns = (pd.array(ids, dtype="Int64"), known.sizes, losses[1], losses[0])
            out.append(pd.DataFrame(dict(zip(names, columns, strict=True))))
        return pd.concat(out) if out else pd.DataFrame([], columns=names)

    return run


def cross_entropy_difference(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu: float = MU
) -> DataFrame:
    """One row per document: id, n_tokens, target_loss, background_loss, score (the difference).

    `target` has the text in a column `text`.
    """
    spark = docs.sparkSession
    small_batches()
    goal = F.lit(True).alias("target")
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.lit(False).alias("target"),
    ).unionByName(target.select(F.lit(None).cast("long").alias("doc_id"), "text", goal))
    blocks = written(texts.mapInPandas(_blocks, BLOCKS), "tokens")
    held = (
        blocks.groupBy("target")
        .agg(F.sum("size").alias("tokens"), F.sum("opened").alias("opened"))
        .collect()
    )
    sent = sum(r["tokens"] for r in held)
    starts = {r["target"]: r["opened"] for r in held}
    buckets = int(max(cores(spark), -(-sent // BUCKET)))
    shift = 31 - (buckets - 1).bit_length()
    answers = written(
        blocks.select("block", "target", "words", "n", "contexts")
        .mapInPandas(_words_sent(buckets), WORDS)
        .groupBy("bucket")
        .applyInPandas(_words_answered(shift), ANSWERS),
        "words",
    )
    sums = answers.agg(*[F.sum(c).alias(c) for c in ("distinct", "tokens", "goal_tokens")]).first()
    by_block = blocks.groupBy("block")
    bigrams = (
        by_block.cogroup(answers.groupBy("block"))
        .applyInPandas(_bigrams_sent(buckets), BIGRAMS)
        .groupBy("bucket")
        .applyInPandas(_bigrams_answered, ANSWERS)
    )
    score = _scored(
        buckets,
        sums["distinct"] or 0,
        [sums["tokens"] or 0, sums["goal_tokens"] or 0],
        [starts.get(False, 0), starts.get(True, 0)],
        mu,
    )
    return (
        by_block.cogroup(answers.unionByName(bigrams).groupBy("block"))
        .applyInPandas(
            score, "doc_id long, n_tokens long, target_loss double, background_loss double"
        )
        .select(
            F.col("doc_id").alias(id_col),
            "n_tokens",
            "target_loss",
            "background_loss",
            (F.col("target_loss") - F.col("background_loss")).alias("score"),
        )
    )
