"""Periodic runs of words: where a text repeats itself at once, at least four times over.

A run is a longest stretch of words with a smallest period q and a length of at least 6 and 4 q.
For every period p, places at multiples of 3 p (a harmonic grid: n log n places in all) are
candidates: a run of period p has one among them from which on words repeat p later. The grammar
of the text (`recompression`) extends each candidate to both sides exactly, without suffix arrays.
Stretches found under several periods keep the smallest.

Texts of a batch share a grammar, set apart by symbols that occur once, up to WORDS words; a longer
text has one of its own and is never cut. Nothing is shuffled. Null and empty texts have no words
and no runs. Ids may be null or repeat; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .recompression import Grammar
from .shared import small_batches

#: Least length of a run, in words and in periods.
LEAST, TIMES = 6, 4
#: Words of the texts that share a grammar; candidates that are looked at together.
WORDS, AT_ONCE = 200_000, 1_000_000

RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(t) for t in texts], np.int64)
    # a mark, the words of the first text, a mark, ...: marks are numbered after the words
    codes = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
    marks = iter(range(len(number), len(number) + len(texts) + 1))
    joined = [x for c in codes for x in ([next(marks)], c)] + [[next(marks)]]
    symbols = np.concatenate(joined).astype(np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    grammar = Grammar(symbols)
    found = [_extended(grammar, x, p) for x, p in _candidates(symbols, begins, sizes)]
    start, end, period = np.concatenate(found, 1) if found else np.empty((3, 0), np.int64)
    start, end, period = _smallest(start, end, period)
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    cuts = np.searchsorted(start, begins[1:]) if len(texts) else []
    rows = np.stack([start, end - start, period], 1)
    return [r - [b, 0, 0] for r, b in zip(np.split(rows, cuts), begins, strict=True)]


def _candidates(
    symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) where the word stands again a period later, on the grid of each period."""
    periods = np.where(sizes >= LEAST, sizes // TIMES, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (TIMES - 1) * p
    places = -(-(sizes[text] - p) // step)
    ends = np.cumsum(places)
    at = 0
    while at < len(p):
        # at least one period at a time; the first has the most places, a third of the words
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        n = places[at:until]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        period = np.repeat(p[at:until], n)
        x = np.repeat(begins[text[at:until]], n) + nth * np.repeat(step[at:until], n)
        same = symbols[x] == symbols[x + period]
        yield x[same], period[same]
        at = until


def _extended(grammar: Grammar, x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """start, end and period of the stretches around candidates that are long enough."""
    end = x + p + grammar.extend(x, x + p, 1)
    start = x - grammar.extend(x - 1, x + p - 1, -1)
    long_ = end - start >= np.maximum(LEAST, TIMES * p)
    return np.stack(_smallest(start[long_], end[long_], p[long_]))


def _smallest(start: np.ndarray, end: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each stretch once, with the smallest period."""
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], p[new]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """False for words that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed: the words that are left, joined
    by one space, where each run keeps its first period. A row per row of documents."""
    small_batches()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw, at = batch[0], batch[1].cast(pa.binary()), 0
            while at < len(batch):
                first, words, held = at, [], 0
                while at < len(batch) and (not words or held < WORDS):
                    # bytes are split at exactly the six ASCII white-space characters
                    words.append((raw[at].as_py() or b"").split())
                    held += len(words[-1])
                    at += 1
                runs = runs_of(words)
                collapsed = [
                    b" ".join(compress(w, kept_words(len(w), r)) if len(r) else w)
                    for w, r in zip(words, runs, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, at - first), pa.array(map(len, words), pa.int64()),
                        _lists(runs), pa.array(collapsed, pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(find, RESULT)


def _lists(runs: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, runs)])
    flat = np.concatenate(runs).astype(np.int64)
    names = ["start", "length", "period"]
    structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=names)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
