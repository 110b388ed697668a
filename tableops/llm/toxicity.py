"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A token (run of non-white-space, lower case) is the sum of two inputs: an embedding of the word,
if it is frequent enough in training, and the mean of embeddings of its character trigrams. Two
gated recurrent layers read a window of tokens in either direction; attention weighs their
states; a logistic unit scores the weighted sum. All windows of a text are scored, each
overlapping the next by half, so every token stands in the middle half of one. The score of a
document is a logistic function of its highest window and the number of windows, fitted on
training documents the network has not seen.

Training: a label says that some window of a text is toxic, or that none is. Of a toxic text the
window that scores highest counts as toxic; of any other the highest and some by chance as not.
The sampled documents are read whole, in tasks: windows to learn from are chosen by their words'
evidence over the whole text, and the calibration sees all windows.

The projections of a word's inputs to all gates are computed once per distinct word, so what a
task does per token is the recurrence alone, on many windows at once.

Null and empty texts are one window of nothing, and get its score. Ties and repeated rows score
alike. Without labels of both kinds there is nothing to learn: every score is the share of
toxic labels (0 without any).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import give_back, small_batches, written

#: Tokens of a window and step between windows.
WINDOW, STEP = 24, 12
#: Sizes: embeddings, states of each direction, attention; hashed trigrams; least word count.
INPUT, STATE, ATTENTION = 16, 12, 8
TRIGRAMS, LEAST = 4096, 4
#: Bound on the labelled documents that training reads, of each label.
SAMPLE = 1500
#: Weight decay, and share of tokens left out of a training window.
DECAY, DROPOUT = 1e-3, 0.2
#: A document is toxic from this score on.
THRESHOLD = 0.3
#: Words whose projections a task remembers; words projected, and windows computed, at once.
REMEMBERED, WORDS, BATCH = 100_000, 4096, 2048


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


_MARKS = ".,;:!?"


class Lexicon:
    """Words as the network reads them: numbers, and hashed trigrams of their characters."""

    def __init__(self, words: list[str], known: dict[str, int]) -> None:
        bare = [w.strip(_MARKS) for w in words]
        self.number = np.fromiter(map(known.get, bare, repeat(len(known))), np.int64, len(bare))
        if "" in bare:
            bare = [w or "-" for w in bare]
        self.sizes = np.fromiter(map(len, bare), np.int64, len(bare))
        marked = f"<{'><'.join(bare)}>" if bare else ""
        points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.uint64)
        # a trigram begins everywhere but at the last two characters of a word
        begins = np.ones(len(points), bool)
        ends = np.cumsum(self.sizes + 2)
        begins[ends - 1] = begins[ends - 2] = False
        mixed = points[:-2] * 0x9E3779B1
        mixed += points[1:-1]
        mixed *= 0x85EBCA77
        mixed += points[2:]
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        mixed >>= np.uint64(40)
        self.grams = mixed[begins[:-2]].astype(np.int64) % TRIGRAMS

    def __len__(self) -> int:
        return len(self.number)

    def take(self, rows: np.ndarray) -> Lexicon:
        out = object.__new__(Lexicon)
        out.number, out.sizes = self.number[rows], self.sizes[rows]
        begins = (np.cumsum(self.sizes) - self.sizes)[rows]
        ends = np.cumsum(out.sizes)
        out.grams = self.grams[
            np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - out.sizes), out.sizes)
        ]
        return out


def window_starts(n: int) -> range:
    """Windows over n tokens; the last begins where the one before ends at the latest."""
    return range(0, max(1, n - STEP), STEP)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scattered(size: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows that go to each place."""
    out = np.zeros((size, *rows.shape[1:]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        begins = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[begins]] = np.add.reduceat(rows[order], begins, axis=0)
    return out


class Network:
    """Parameters and passes. Projections: 3 gates (update, reset, new) for each direction."""

    def __init__(self, words: dict[str, int], rng: np.random.Generator) -> None:
        self.words = words
        g = 3 * STATE

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": normal(len(words) + 1, INPUT, scale=0.1),
            "tri": normal(TRIGRAMS, INPUT, scale=0.1),
            "in": normal(2, INPUT, g, scale=INPUT**-0.5),
            "bias": np.zeros((2, g), np.float32),
            "rec": normal(2, STATE, g, scale=STATE**-0.5),
            "att": normal(2 * STATE, ATTENTION, scale=(2 * STATE) ** -0.5),
            "attb": np.zeros(ATTENTION, np.float32),
            "attv": normal(ATTENTION, scale=ATTENTION**-0.5),
            "out": normal(2 * STATE, scale=(2 * STATE) ** -0.5),
            "outb": np.full(1, -2.0, np.float32),
        }

    def inputs(self, words: Lexicon) -> np.ndarray:
        """Word plus mean trigram embedding."""
        if not len(words):
            return np.zeros((0, INPUT), np.float32)
        begins = np.cumsum(words.sizes) - words.sizes
        chars = np.add.reduceat(self.p["tri"].take(words.grams, axis=0), begins, axis=0)
        return self.p["word"][words.number] + chars / words.sizes[:, None].astype(np.float32)

    def projected(self, words: Lexicon) -> np.ndarray:
        """What a word gives to all gates: (words, 2, 3 STATE)."""
        x = self.inputs(words)
        return np.stack([x @ self.p["in"][d] + self.p["bias"][d] for d in (0, 1)], axis=1)

    def forward(self, proj: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows; ids: (windows, WINDOW) rows of proj, -1 where there is no token."""
        n, steps = ids.shape
        live = (ids >= 0).astype(np.float32)
        states = np.zeros((n, steps, 2 * STATE), np.float32)
        kept: list = []
        for d in (0, 1):
            h = np.zeros((n, STATE), np.float32)
            rec = self.p["rec"][d]
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                m = live[:, t, None]
                x = proj[ids[:, t], d]
                hz = h @ rec[:, : 2 * STATE]
                zr = _sigmoid(x[:, : 2 * STATE] + hz)
                z, r = zr[:, :STATE], zr[:, STATE:]
                hn = h @ rec[:, 2 * STATE :]
                new = np.tanh(x[:, 2 * STATE :] + r * hn)
                if keep:
                    kept.append((d, t, h, z, r, hn, new, m))
                h = h + m * (1 - z) * (new - h)
                states[:, t, d * STATE : (d + 1) * STATE] = h
        a = np.tanh(states @ self.p["att"] + self.p["attb"])
        e = a @ self.p["attv"] + (live - 1) * 1e4
        e = np.exp(e - e.max(axis=1, keepdims=True)) * np.maximum(live, 1e-9)
        alpha = e / e.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nts->ns", alpha, states)
        logit = pooled @ self.p["out"] + self.p["outb"][0]
        return (logit, kept, states, a, alpha, pooled) if keep else logit

    def gradients(self, words: Lexicon, ids: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """Loss and gradients of windows over distinct words."""
        x_in, proj = self.inputs(words), self.projected(words)
        logit, kept, states, a, alpha, pooled = self.forward(proj, ids, keep=True)
        prob = _sigmoid(logit)
        total = weight.sum()
        loss = -(weight * (target * np.log(prob + 1e-7) + (1 - target) * np.log(1 - prob + 1e-7)))
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        dlogit = (weight * (prob - target) / total).astype(np.float32)
        g["out"], g["outb"][0] = pooled.T @ dlogit, dlogit.sum()
        dpooled = dlogit[:, None] * self.p["out"]
        dalpha = np.einsum("ns,nts->nt", dpooled, states)
        dstates = alpha[:, :, None] * dpooled[:, None, :]
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=1, keepdims=True))
        g["attv"] = np.einsum("nt,nta->a", de, a)
        da = de[:, :, None] * self.p["attv"] * (1 - a * a)
        g["att"] = np.einsum("nts,nta->sa", states, da)
        g["attb"] = da.sum(axis=(0, 1))
        dstates += da @ self.p["att"].T
        dgates = np.zeros((*ids.shape, 2, 3 * STATE), np.float32)
        dh = None
        for d, t, h, z, r, hn, new, m in reversed(kept):
            if dh is None or dh[0] != d:
                dh = (d, np.zeros_like(h))
            grad = dh[1] + dstates[:, t, d * STATE : (d + 1) * STATE]
            dnew = grad * m * (1 - z) * (1 - new * new)
            dz = grad * m * (h - new) * z * (1 - z)
            dr = dnew * hn * r * (1 - r)
            rec = self.p["rec"][d]
            dzr = np.concatenate([dz, dr], axis=1)
            g["rec"][d][:, : 2 * STATE] += h.T @ dzr
            g["rec"][d][:, 2 * STATE :] += h.T @ (dnew * r)
            back = grad * (1 - m * (1 - z)) + dzr @ rec[:, : 2 * STATE].T
            dh = (d, back + (dnew * r) @ rec[:, 2 * STATE :].T)
            dgates[:, t, d, : 2 * STATE], dgates[:, t, d, 2 * STATE :] = dzr, dnew
        there = ids >= 0
        dproj = _scattered(len(words), ids[there], dgates[there])
        g["bias"] = dproj.sum(axis=0)
        dx = 0
        for d in (0, 1):
            g["in"][d] = x_in.T @ dproj[:, d]
            dx = dx + dproj[:, d] @ self.p["in"][d].T
        g["word"] = _scattered(len(g["word"]), words.number, dx)
        each = np.repeat(dx / words.sizes[:, None].astype(np.float32), words.sizes, axis=0)
        g["tri"] = _scattered(TRIGRAMS, words.grams, each)
        g["word"][-1] = 0
        return float(loss.sum() / total), g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float) -> None:
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        clip = min(1.0, 1.0 / (norm + 1e-9))
        for k, x in g.items():
            x = x * clip + DECAY * self.p[k]
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.p[k] -= (self.rate * rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


class Model:
    """A trained network with the calibration of documents."""

    def __init__(self, network: Network | None, calibration: np.ndarray, share: float) -> None:
        self.network, self.calibration, self.share = network, calibration, share

    def score(self, best: np.ndarray, windows: np.ndarray) -> np.ndarray:
        x = np.stack([best, np.log(windows), np.ones(len(best))], axis=1)
        return _sigmoid(x @ self.calibration)


def distinct_words(texts: list[list[str]]) -> tuple[list[str], np.ndarray]:
    """Distinct words of tokenised texts, and for each word in turn which of these it is.

    Arrow tells them apart by their bytes; a word holds no white space, so a line feed ends it.
    """
    lines = "".join(["\n".join([*t, ""]) for t in texts]).encode("utf-8", "surrogatepass")
    ends = np.flatnonzero(np.frombuffer(lines, np.uint8) == ord("\n")) + 1
    offsets = np.concatenate([[0], ends])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(lines)]
    ).dictionary_encode()
    _, offsets, lines = words.dictionary.buffers()
    size = np.frombuffer(offsets, np.int64)[len(words.dictionary)] if len(ends) else 0
    distinct = lines.to_pybytes()[:size].decode("utf-8", "surrogatepass") if size else ""
    return distinct.split("\n")[:-1], words.indices.to_numpy()


class Numbers(dict):
    """Words numbered from 1 as they are asked for; 0 is no word."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self) + 1
        return number


class Scorer:
    """A model in a task; remembers the projections of words up to a bound.

    Texts are laid out in blocks of STEP tokens, and a window is WINDOW // STEP blocks in a row. So
    a token is looked up once, however many windows hold it, and what a step of the recurrence
    reads of all windows lies together: a row a gate, a column a window. The arithmetic is that of
    `Network.forward`.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known = Numbers()
        # row 0 stands where there is no word: its update gate keeps the state as it is
        self.proj = np.zeros((1, 2, 3 * STATE), np.float32)
        self.proj[:, :, :STATE] = 1e3
        self.uses = np.zeros(1, np.int64)

    def _numbered(self, texts: list[list[str]]) -> np.ndarray:
        """Numbers of all words of the texts, their projections being remembered."""
        if len(self.known) > REMEMBERED:
            self._forget()
        distinct, which = distinct_words(texts)
        old = len(self.known)
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        words = list(islice(self.known, old, None))
        self._room(old + 1 + len(words))
        # few words at a time, so that what they are made from stays in the processor's cache
        for at in range(0, len(words), WORDS):
            some = Lexicon(words[at : at + WORDS], self.model.network.words)
            self.proj[old + 1 + at :][: len(some)] = self.model.network.projected(some)
        self.uses[numbers] += np.bincount(which, minlength=len(distinct))
        return numbers[which]

    def _room(self, rows: int) -> None:
        """At least so many rows; room is made ahead, in steps, so that rows are seldom copied."""
        if rows > len(self.proj):
            more = max(rows, min(2 * len(self.proj), REMEMBERED)) - len(self.proj)
            self.proj = np.concatenate([self.proj, np.zeros((more, 2, 3 * STATE), np.float32)])
            self.uses = np.concatenate([self.uses, np.zeros(more, np.int64)])

    def _forget(self) -> None:
        """All but the most used words, half as many as are remembered; their uses count half."""
        uses = self.uses[1 : len(self.known) + 1]
        kept = np.sort(np.argsort(-uses, kind="stable")[: REMEMBERED // 2])
        words = list(self.known)
        rows = np.concatenate([[0], kept + 1])
        self.known = Numbers(zip([words[i] for i in kept.tolist()], range(1, len(rows))))
        self.proj, self.uses = self.proj[rows], self.uses[rows] // 2

    @np.errstate(over="ignore")  # exp of a gate that is shut
    def _logits(self, blocks: np.ndarray) -> np.ndarray:
        """Logits of the windows that begin at each of the blocks but the last ones."""
        p, span = self.model.network.p, WINDOW // STEP
        n = len(blocks) - span + 1
        x = self.proj.take(blocks.T.ravel(), axis=0).reshape(STEP, len(blocks), 2, 3 * STATE)
        x = np.ascontiguousarray(x.transpose(0, 2, 3, 1))
        states = np.empty((WINDOW, 2 * STATE, n), np.float32)
        gates, turn = np.empty((3 * STATE, n), np.float32), np.empty((STATE, n), np.float32)
        both, new = gates[: 2 * STATE], gates[2 * STATE :]
        for d in (0, 1):
            h = np.zeros((STATE, n), np.float32)
            rec = np.ascontiguousarray(p["rec"][d].T)
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                own = x[t % STEP, d, :, t // STEP : t // STEP + n]
                np.matmul(rec, h, out=gates)
                both += own[: 2 * STATE]
                np.negative(both, out=both)
                np.exp(both, out=both)
                both += 1
                np.divide(1, both, out=both)
                new *= both[STATE:]
                new += own[2 * STATE :]
                np.tanh(new, out=new)
                new -= h
                np.subtract(1, both[:STATE], out=turn)
                new *= turn
                h = np.add(h, new, out=states[t, d * STATE : (d + 1) * STATE])
        a = np.matmul(p["att"].T, states)
        a += p["attb"][:, None]
        np.tanh(a, out=a)
        live = np.concatenate([(blocks[i : i + n] > 0) for i in range(span)], axis=1)
        e = np.ascontiguousarray(np.matmul(p["attv"], a).T) + np.where(live, 0, np.float32(-1e4))
        e = np.exp(e - e.max(axis=1, keepdims=True)) * np.where(live, 1, np.float32(1e-9))
        alpha = np.ascontiguousarray((e / e.sum(axis=1, keepdims=True)).T)
        states *= alpha[:, None]
        return np.ascontiguousarray(states.sum(axis=0).T) @ p["out"] + p["outb"][0]

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Highest logit, and number of windows, of each tokenised text."""
        count = np.array([len(window_starts(len(t))) for t in texts], np.int64)
        best = np.full(len(texts), -np.inf, np.float32)
        span = WINDOW // STEP
        # as many texts at a time as have few distinct words, so the store stays in its bound
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end]) <= REMEMBERED):
                held += len(texts[end])
                end += 1
            numbers = self._numbered(texts[at:end])
            sizes = np.array([len(t) for t in texts[at:end]], np.int64)
            ends = np.cumsum(count[at:end] + span - 1)
            begins = (ends - count[at:end] - span + 1) * STEP - (np.cumsum(sizes) - sizes)
            codes = np.zeros(ends[-1] * STEP, np.int64)
            codes[np.arange(len(numbers)) + np.repeat(begins, sizes)] = numbers
            blocks = codes.reshape(-1, STEP)
            # windows that would reach from one text into the next have no owner
            owner = np.repeat(np.arange(at, end), count[at:end] + span - 1)
            owner[(ends[:, None] - np.arange(1, span)).ravel()] = -1
            for first in range(0, len(blocks) - span + 1, BATCH):
                logit = self._logits(blocks[first : first + BATCH + span - 1])
                own = owner[first : first + len(logit)]
                np.maximum.at(best, own[own >= 0], logit[own >= 0])
            at = end
        return best, count

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.model.network is None:
            return np.full(len(texts), self.model.share)
        best, count = self.windows([tokens(t) for t in texts])
        return self.model.score(best, count)


def windows_of(words: list[str]) -> list[list[str]]:
    """All windows; the last may be short, and a text without words has one of none."""
    return [words[at : at + WINDOW] for at in window_starts(len(words))]


def calibrates(id_: object) -> bool:
    """A fifth of the sampled documents, by hash, is kept from the network for the calibration."""
    return zlib.crc32(f"fold:{id_}".encode()) % 5 == 0


def bare(word: str) -> str:
    return word.strip(_MARKS)


def count_words(rows: Iterator[tuple]) -> dict[str, list[int]]:
    """Of each word: documents, documents the network learns from, and toxic ones among these."""
    counts: dict[str, list[int]] = {}
    for id_, text, label in rows:
        learns = not calibrates(id_)
        for w in {bare(w) for w in tokens(text)}:
            n = counts.setdefault(w, [0, 0, 0])
            n[0] += 1
            n[1] += learns
            n[2] += learns and label
    return counts


def evidence_of(counts: dict[str, list[int]], share: float) -> dict[str, float]:
    """How much more often than by chance a word stands in toxic texts, in standard deviations.

    Of words in at least LEAST sampled documents.
    """
    return {
        w: (k - n * share) / float(np.sqrt(n * share * (1 - share) + 1))
        for w, (every, n, k) in counts.items() if w and every >= LEAST
    }


def chosen_windows(id_: object, text: str | None, evidence: dict[str, float]) -> list[list[str]]:
    """Windows of a whole text to learn from: those with the words of most evidence, and some by
    chance."""
    words = tokens(text)
    strength = np.full(len(window_starts(len(words))) * STEP + WINDOW, -9.0)
    strength[: len(words)] = [evidence.get(bare(w), 0.0) for w in words]
    best = np.lib.stride_tricks.sliding_window_view(strength, WINDOW)[::STEP].max(axis=1)
    best = best[: len(window_starts(len(words)))]
    rng = np.random.default_rng(zlib.crc32(f"windows:{id_}".encode()))
    some = rng.choice(len(best), min(len(best), 4), replace=False)
    picked = sorted({*np.argsort(-best, kind="stable")[:4].tolist(), *some.tolist()})
    return [words[i * STEP : i * STEP + WINDOW] for i in picked]


def fit(
    examples: list[tuple], evidence: dict[str, float], rounds: int = 4, batches: int = 60, seed: int = 7
) -> Network:
    """The network from (id, label, windows); the same examples give the same network.

    Round by round the network chooses among the windows of a text.
    """
    examples = sorted(examples, key=lambda r: (zlib.crc32(f"order:{r[0]}".encode()), str(r[0])))
    labels = np.array([r[1] for r in examples], np.float32)
    rng = np.random.default_rng(seed)
    network = Network({w: i for i, w in enumerate(sorted(evidence))}, rng)
    adam = Adam(network.p, 0.015)
    vocabulary = sorted({w for r in examples for window in r[2] for w in window})
    known = {w: i for i, w in enumerate(vocabulary)}
    lexicon = Lexicon(vocabulary, network.words)
    strength = np.array([evidence.get(bare(w), 0.0) for w in vocabulary] + [-9.0])
    owner = np.repeat(np.arange(len(examples)), [len(r[2]) for r in examples])
    every = np.full((len(owner), WINDOW), -1, np.int64)
    for row, window in enumerate(w for r in examples for w in r[2]):
        every[row, : len(window)] = [known[w] for w in window]
    first = np.searchsorted(owner, np.arange(len(examples) + 1))
    rank = strength[every].max(axis=1)
    for r in range(rounds):
        if r:
            proj = network.projected(lexicon)
            rank = np.concatenate(
                [network.forward(proj, every[i : i + BATCH]) for i in range(0, len(every), BATCH)]
            )
        pos, neg = [], []
        for i, label in enumerate(labels):
            own = np.arange(first[i], first[i + 1])
            if label:
                pos.append(own[np.argmax(rank[own])])
            else:
                neg.append(own[np.argsort(-rank[own], kind="stable")[:2]])
                neg.append(rng.choice(own, min(len(own), 2), replace=False))
        pos, neg = np.array(pos), np.concatenate(neg)
        for _ in range(batches):
            pick = np.concatenate(
                [rng.choice(pos, min(len(pos), 64)), rng.choice(neg, min(len(neg), 160))]
            )
            ids = np.where(rng.random((len(pick), WINDOW)) < DROPOUT, -1, every[pick])
            used, inverse = np.unique(ids, return_inverse=True)
            inverse = inverse.reshape(ids.shape)
            gone = int(used[0] < 0)
            words = lexicon.take(used[gone:])
            if not len(words):
                continue
            weight = np.ones(len(pick), np.float32)
            _, g = network.gradients(words, inverse - gone, labels[owner[pick]], weight)
            adam.step(g, 0.3 if r == rounds - 1 else 1.0)
    return network


def share_of(learnt: tuple[int, int]) -> float:
    """Share of toxic among (documents, toxic ones)."""
    return learnt[1] / learnt[0] if learnt[0] else 0.0


def train(rows: list[tuple], rounds: int = 4, batches: int = 60) -> Model:
    """Network and calibration from (id, text, label), or (id, text, label, stands), in this process.

    `stands` is the number of labelled rows that a row stands for, 1 without it. It weighs the
    calibration, so that scores are chances among all labelled rows, not among the sample.
    """
    stands = np.array([r[3] if len(r) > 3 else 1.0 for r in rows])
    labels = np.array([r[2] for r in rows], np.float64)
    share = float(np.average(labels, weights=stands)) if len(rows) else 0.0
    inside = [r for r in rows if not calibrates(r[0])]
    learnt = (len(inside), sum(r[2] for r in inside))
    if learnt[1] in (0, learnt[0]):
        return Model(None, np.zeros(3), share)
    evidence = evidence_of(count_words(r[:3] for r in rows), share_of(learnt))
    examples = [(r[0], r[2], chosen_windows(r[0], r[1], evidence)) for r in inside]
    network = fit(examples, evidence, rounds, batches)
    held = [i for i, r in enumerate(rows) if calibrates(r[0])]
    best, n = Scorer(Model(network, np.zeros(3), 0.0)).windows([tokens(rows[i][1]) for i in held])
    return Model(network, _calibrate(best, n, labels[held], stands[held]), share)


def _calibrate(
    best: np.ndarray, windows: np.ndarray, y: np.ndarray, stands: np.ndarray
) -> np.ndarray:
    """Logistic regression on (logit, log windows, 1) by Newton steps with a small penalty.

    Weights are 1 on average, so that the penalty counts the same at every size of the input.
    """
    if not len(y):
        return np.array([1.0, 0.0, 0.0])
    v = stands / stands.mean()
    x = np.stack([best, np.log(windows), np.ones(len(best))], axis=1).astype(np.float64)
    w = np.array([1.0, 0.0, 0.0])
    prior = w.copy()
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (v * (p - y)) + 1.0 * (w - prior) * [1, 1, 0.01]
        hess = (x * (v * p * (1 - p))[:, None]).T @ x + np.diag([1, 1, 0.01])
        w = w - np.clip(np.linalg.solve(hess, g), -1, 1)
    w[0] = max(w[0], 1e-3)
    return w


def held_out(id_: Column) -> Column:
    """True for the documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sampled(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """At most `bound` labelled documents of each label, by hash of the id: doc_id, text, toxic and
    stands, the number of labelled rows that it stands for. One row a document, texts whole.

    The ids are bounded before texts are read, and small enough to be sent to all tasks.
    """
    learnt = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    held = learnt.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()
    stands = {r["toxic"]: max(r["count"] / bound, 1.0) for r in held}
    ids = None
    for label in (0, 1):
        part = (
            labels.where((F.col("toxic") == label) & ~held_out(F.col("doc_id")))
            .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(bound)
        )
        ids = part if ids is None else ids.unionByName(part)
    text = F.coalesce("text", F.lit("")).alias("text")
    joined = docs.select("doc_id", text).join(F.broadcast(ids), "doc_id")
    one = joined.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("row"))
    weight = F.when(F.col("row.toxic") == 1, stands.get(1, 1.0)).otherwise(stands.get(0, 1.0))
    return one.select("doc_id", "row.text", "row.toxic", weight.cast("double").alias("stands"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """What `train` gives for the sampled rows, with everything that reads texts done in tasks.

    Only counts of words in at least LEAST of the sampled documents, at most 8 windows of 24 words
    a document and the two figures of the calibration come to the driver.
    """
    rows = written(sampled(docs, labels, bound), "sample")
    counts = rows.groupBy("toxic", "stands", "doc_id").count().drop("count")
    seen = counts.select("doc_id", "toxic", "stands").toArrow().to_pylist()
    weight = sum(r["stands"] for r in seen)
    share = sum(r["stands"] * r["toxic"] for r in seen) / weight if seen else 0.0
    inside = [r["toxic"] for r in seen if not calibrates(r["doc_id"])]
    if sum(inside) in (0, len(inside)):
        return Model(None, np.zeros(3), share)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = count_words(zip(frame["doc_id"], frame["text"], frame["toxic"], strict=True))
            yield pd.DataFrame(
                [(w, *n) for w, n in found.items()], columns=["word", "every", "inside", "hits"]
            )

    words = (
        rows.mapInPandas(count, "word string, every long, inside long, hits long")
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("every", "inside", "hits")])
        .where(F.col("every") >= LEAST)
    )
    found = {r["word"]: [r["every"], r["inside"], r["hits"]] for r in words.toArrow().to_pylist()}
    evidence = evidence_of(found, share_of((len(inside), sum(inside))))
    shared = rows.sparkSession.sparkContext.broadcast(evidence)

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept = frame[[not calibrates(i) for i in frame["doc_id"]]]
            windows = [
                chosen_windows(i, t, shared.value)
                for i, t in zip(kept["doc_id"], kept["text"], strict=True)
            ]
            yield pd.DataFrame({"doc_id": kept["doc_id"], "toxic": kept["toxic"], "windows": windows})

    examples = rows.mapInPandas(choose, "doc_id long, toxic int, windows array<array<string>>")
    network = fit(
        [(r["doc_id"], r["toxic"], r["windows"]) for r in examples.toArrow().to_pylist()], evidence
    )
    unfinished = Model(network, np.zeros(3), 0.0)

    def rate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(unfinished)
        for frame in frames:
            held = frame[[calibrates(i) for i in frame["doc_id"]]]
            best, n = scorer.windows([tokens(t) for t in held["text"]])
            columns = held[["doc_id", "toxic", "stands"]]
            yield columns.assign(best=best.astype(np.float64), n=n)

    schema = "doc_id long, toxic int, stands double, best double, n long"
    held = sorted(rows.mapInPandas(rate, schema).toArrow().to_pylist(), key=lambda r: r["doc_id"])
    best, n, y, stands = (
        np.array([r[c] for r in held], np.float64) for c in ("best", "n", "toxic", "stands")
    )
    return Model(network, _calibrate(best, n, y, stands), share)


def toxicity(docs: DataFrame, labels: DataFrame, text: Column, bound: int = SAMPLE) -> Column:
    """Column of scores for `text`, learnt from labelled rows of docs."""
    small_batches()
    return scores(text, learn(docs, labels, bound))


def scores(text: Column, model: Model) -> Column:
    small_batches()

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            parts = [
                scorer.score(texts.iloc[i : i + 500].tolist()) for i in range(0, len(texts), 500)
            ]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")
        give_back()

    return of(text)
