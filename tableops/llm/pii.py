"""Personal data: rules for plain forms, and a linear-chain conditional random field for others.

The rules find e-mail addresses, IP addresses, card and phone numbers, leftmost and without
overlap for each kind. The field labels every token (run of non-space) with a kind or none, from
features of its shape; it is trained from the labelled table below and decoded by Viterbi in
numpy batches. Runs of tokens of one kind that pass the check of that kind and overlap nothing
the rules found are added: phone numbers without a plus, masked addresses, other separators.

Decoding is exact and covers whole texts. A token whose score for "none" is ahead of every kind
by more than transitions can ever make up is "none" in the best path whatever its neighbours are.
Paths are therefore cut at such tokens (nearly all words), and the stretches between are decoded.

A null or empty text has no spans. Offsets are code points, ends exclusive. Rows stay rows,
repeated or not; other columns are untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .shared import small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Words whose scores a task remembers; beyond that it starts anew.
REMEMBERED = 300_000

#: The labelled table. {kind:..} marks personal data, all else is none.
TRAINING = """
write to {email:ana.lopez@mail.example.org} before noon
mail {email:j.brown@corp-site.com}, please
{email:kim(at)web.example.net} is the desk
reach us under {email:info[at]shop.example.com} or by post
his address {email:t_smith@uni.edu}.
send it to {email:paul [at] home [dot] org} today
ask {email:eva (at) lab (dot) net} for the key
contact {email:m.roy(at)firm(dot)com}!
{email:sales@x1.example.co.uk}; thanks
forward to {email:o.wild{at}mail{dot}de} soon
host {ip:192.168.0.14} is down
the server at {ip:10.0.0.7}, port open
from {ip:172.16.254.1}. Then it stopped
ping {ip:8[.]8[.]4[.]4} again
blocked {ip:203[.]0[.]113[.]9} on friday
traffic of {ip:198.51.100.23:8080} rises
{ip:77.51.8.190} and {ip:45.9.20.5} are up
paid by card {card:4111 1111 1111 1111} yesterday
card {card:5500-0000-0000-0004} was refused
number {card:4012888888881881} is stored
use {card:6011.1111.1111.1117} for this
old card {card:4222/2222/2222/2220} expired
{card:3566 0020 2036 0505}, valid till may
charge {card:4000_0566_5566_5556} now
call {phone:+1 (212) 555-0188} after six
phone {phone:(415) 555-2671} or write
my number is {phone:555-201-7788}.
dial {phone:212.555.0147} for help
tel {phone:+44 20 7946 0958} in london
ring {phone:(030) 901-8204}, extension two
fax {phone:617-555-0199}; office hours
{phone:020 7946 0321} is the desk
cell {phone:1-800-555-0112} day and night
text {phone:(312)555-0164} to join
office {phone:(212) 555 0143} closes early
under {phone:+49-89-636-48018} all week
the river and the hill were green in spring
Der Weg ist nicht weit, und die Stadt ist alt.
Les enfants de la ville jouent au bord du lac.
El camino por la montaña es largo y hermoso.
It was founded in 1987 and closed in 2004.
version 2.0. of the licence, section 4.1 applies
chapter 12, page 345, line 6 of the book
released under CC BY-NC 4.0. in all countries
on 2021-03-14 at 10:30 the gate opened
the date is 12/05/2019 or 03.11.2020 in short
prices rose from 1,250,000 to 1,380,500 units
token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" was found
key "04dbebab91ab85687d33eeaaf9ac699e1188f962" and more
id 48211907 and order 99120345561 are numbers
see https://www.example.com/page?id=77 for all
a ratio of 3.14159 and 2.71828 to 1
about 20-30 people or 5-6 in all (see below)
TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! AND!! MORE!!
what*** here### is%%% this$$$ and&&& that
| a | b | c | 17 | 42 |
page [12] and note (3) or (1999) of [4]
he said: "yes", (maybe) or not; then -- no
5 apples, 10 pears & 200 nuts = 215 things
COVID-19 and F-16 or B2B and 3D in 4K
1.2.3.4.5 is a long version, 2.4.1 a short one
serial 0001-2234-99 and code A12-B34-C56
""".strip().splitlines()

_MARK = re.compile(r"\{(email|ip|card|phone):((?:[^{}]|\{at\}|\{dot\})*)\}")


# --- rules ---------------------------------------------------------------------------

_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """From each @ outwards, so that long runs without one cost nothing."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the rules; the possessive forms find what the plain ones do, without retries."""
    spans: dict[str, list[Span]] = {k: [] for k in KINDS}
    spans["email"] = emails(text)
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans["ip"].append(m.span())
    for m in _CARD.finditer(text):
        # a match of 19 digits has at most 18 separators
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() <= 37 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans["phone"].append(m.span())
    return spans


# --- the field -----------------------------------------------------------------------

_DIGITS = re.compile(r"[0-9]+")
_UPPER = re.compile(r"[^\W\d_a-z]+")
_EDGE = ".,;:!?\"'%&*$#|"


def features(word: str) -> list[str]:
    """Shape features of a token; the long are cut to their class, not their content."""
    core = word.strip(_EDGE) or word
    runs = _DIGITS.findall(core)
    n = sum(map(len, runs))
    kinds = "".join(
        sorted({"a" if c.isalpha() else "0" if c.isdigit() else c if c in "@.-+()[]/:_{}" else "~"
                for c in core})
    )
    shape = re.sub(r"[^\W\d_]+", "a", core)
    shape = _DIGITS.sub(lambda m: "0" * min(len(m[0]), 6), shape)
    masked = bool(re.search(r"[(\[{](?:at|dot)[)\]}]", core.lower()))
    out = [
        "bias",
        f"kinds={kinds}",
        f"digits={n if n < 5 else 5 + (n > 6) + (n > 9) + (n > 12) + (n > 15) + (n > 19)}",
        f"runs={min(len(runs), 5)}",
        f"first={_class(word[0])}",
        f"last={_class(core[-1])}",
        f"at={'@' in core}",
        f"masked={masked}",
        f"letters={any(c.isalpha() for c in core)}",
    ]
    if n or masked or len(shape) <= 3:
        out.append(f"shape={shape[:24]}")
    if n and not any(c.isalpha() for c in core):
        out.append(f"lengths={'-'.join(str(len(r)) for r in runs[:6])}")
        if n == sum(c.isdigit() or c in "0123456789" for c in core) == len(core):
            out.append(f"plain={n if n < 5 else 5 + (n > 6) + (n > 12)}")
    return out


def _class(c: str) -> str:
    return "a" if c.isalpha() else "0" if c.isdigit() else c


def labelled(lines: list[str]) -> list[tuple[list[str], list[int]]]:
    """Tokens and labels of the table. A plain word is none, also in a masked address."""
    out = []
    for line in lines:
        plain, marks, at = "", [], 0
        for m in _MARK.finditer(line):
            plain += line[at : m.start()]
            marks.append((len(plain), len(plain) + len(m[2]), LABELS.index(m[1])))
            plain += m[2]
            at = m.end()
        plain += line[at:]
        words, labels = [], []
        for m in re.finditer(r"\S+", plain):
            words.append(m[0])
            kind = next((k for a, b, k in marks if m.start() < b and m.end() > a), 0)
            labels.append(0 if m[0].strip(_EDGE).isalpha() else kind)
        out.append((words, labels))
    return out


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights of features by label and of transitions; both ends of a text count as none."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> None:
        self.names, self.weights, self.moves = names, weights, moves
        # most that a label other than none can gain by its two transitions
        gain = moves[:, :, None] + moves[None, :, :]
        self.margin = float((gain[:, 1:, :] - gain[:, :1, :]).max()) + 1e-9

    def scores(self, word: str) -> np.ndarray:
        found = [self.names[f] for f in features(word) if f in self.names]
        return self.weights[found].sum(axis=0) if found else np.zeros(len(LABELS))

    def viterbi(self, segments: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each segment (scores by token) between two tokens that are none."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(segments)
        order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
        at = 0
        while at < len(order):
            n = len(segments[order[at]])
            end, room = at, max(1, 200_000 // max(n, 1))
            while end < len(order) and len(segments[order[end]]) == n and end - at < room:
                end += 1
            batch = np.stack([segments[i] for i in order[at:end]])
            best = self.moves[0] + batch[:, 0]
            back = np.zeros((n, len(batch), len(LABELS)), np.int8)
            for t in range(1, n):
                paths = best[:, :, None] + self.moves
                back[t] = paths.argmax(axis=1)
                best = paths.max(axis=1) + batch[:, t]
            label = (best + self.moves[:, 0]).argmax(axis=1)
            labels = np.zeros((len(batch), n), np.int64)
            for t in range(n - 1, -1, -1):
                labels[:, t] = label
                if t:
                    label = back[t][np.arange(len(batch)), label]
            for i, row in zip(order[at:end], labels, strict=True):
                out[i] = row
            at = end
        return out


def train(lines: list[str] = TRAINING, steps: int = 300, rate: float = 0.15, decay=(0.002, 1.0)):
    """Maximum likelihood with quadratic penalties, by Adam on the whole table.

    The penalty on transitions is the larger one: the weaker they are, the sooner a token's own
    score decides, and the more places there are at which paths can be cut.
    """
    data = labelled(lines)
    names: dict[str, int] = {}
    for words, _ in data:
        for word in words:
            for f in features(word):
                names.setdefault(f, len(names))
    k, longest = len(LABELS), max(len(w) for w, _ in data)
    x = np.zeros((len(data), longest, len(names)))
    y = np.zeros((len(data), longest), np.int64)
    mask = np.zeros((len(data), longest))
    for s, (words, labels) in enumerate(data):
        for t, word in enumerate(words):
            x[s, t, [names[f] for f in features(word)]] = 1
        y[s, : len(words)], mask[s, : len(words)] = labels, 1
    gold = np.eye(k)[y] * mask[:, :, None]
    before = np.concatenate([np.zeros((len(data), 1), np.int64), y[:, :-1]], axis=1)
    pairs = np.einsum("sta,stb,st->ab", np.eye(k)[before], np.eye(k)[y], mask)
    last = y[np.arange(len(data)), mask.sum(1).astype(int) - 1]
    np.add.at(pairs, (last, 0), 1)
    weights = [np.zeros((len(names), k)), np.zeros((k, k))]
    first, second = [0 * w for w in weights], [0 * w for w in weights]
    for step in range(1, steps + 1):
        w, moves = weights
        e = x @ w
        alpha = np.zeros_like(e)
        alpha[:, 0] = moves[0] + e[:, 0]
        for t in range(1, longest):
            here = _sum_exp(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, here, alpha[:, t - 1])
        beta = np.broadcast_to(moves[:, 0], alpha[:, 0].shape).copy()
        logz = _sum_exp(alpha[:, -1] + moves[:, 0], 1)
        expected = np.zeros_like(moves)
        ends = np.exp(alpha[:, -1] + moves[:, 0] - logz[:, None])
        expected[:, 0] += ends.sum(0)
        marginal = np.zeros_like(e)
        for t in range(longest - 1, -1, -1):
            live = mask[:, t, None]
            marginal[:, t] = np.exp(alpha[:, t] + beta - logz[:, None]) * live
            prior = alpha[:, t - 1] if t else np.where(np.arange(k) == 0, 0.0, -1e30)[None, :]
            joint = prior[:, :, None] + moves + (e[:, t] + beta - logz[:, None])[:, None, :]
            expected += (np.exp(joint) * live[:, :, None]).sum(0)
            here = _sum_exp(moves + (e[:, t] + beta)[:, None, :], 2)
            beta = np.where(live > 0, here, beta)
        grads = [
            np.einsum("stf,stk->fk", x, marginal - gold) + decay[0] * w,
            expected - pairs + decay[1] * moves,
        ]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            scale = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
            weights[i] = weights[i] - rate * scale * (0.99**step)
    return Field(names, *weights)


@lru_cache(maxsize=1)
def trained() -> Field:
    return train()


# --- both ----------------------------------------------------------------------------

_MASKED_AT = re.compile(r"@|[(\[{]\s*at\s*[)\]}]", re.IGNORECASE)
_MASK = re.compile(r"[(\[{](?:at|dot)[)\]}]", re.IGNORECASE)
_LEFT = "\"'<,;:!?"
_RIGHT = ".,;:!?\"'%&*$#>|"


def plausible(kind: str, piece: str) -> bool:
    """The check a span of the field must pass."""
    digits = "".join(c for c in piece if c in "0123456789")
    if kind == "email":
        dotted = re.sub(r"\s*[(\[{]\s*dot\s*[)\]}]\s*", ".", piece, flags=re.IGNORECASE)
        parts = _MASKED_AT.split(dotted)
        return len(parts) == 2 and bool(parts[0].strip()) and "." in parts[1].strip(" .")
    if kind == "ip":
        parts = re.split(r"\[\.\]|\(\.\)|\.", piece.split(":")[0])
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) < 256 for p in parts)
    if re.search(r"[^\W\d_]", piece):
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    # a phone number has parts: a bare run of digits is an ordinary number
    return 7 <= len(digits) <= 15 and len(_DIGITS.findall(piece)) > 1


class Finder:
    """Rules and field in a task."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.known: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def _learn(self, words) -> None:
        plain = self.field.scores("a")
        if plain[0] - plain[1:].max() > self.field.margin:
            # all words of letters, with marks at most at the end, have the features of this one
            easy = {w for w in words if w[0].isalpha() and w.rstrip(_EDGE).isalpha()}
            self.known.update(dict.fromkeys(easy, -1))
            words = words - easy
        for word in words:
            scores = self.field.scores(word)
            if scores[0] - scores[1:].max() > self.field.margin:
                self.known[word] = -1
            else:
                self.known[word] = len(self.rows)
                self.rows.append(scores)

    def find(self, texts: list[str]) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
        """For each text the spans of the rules, and those the field adds."""
        found, open_ = [], []
        for text in texts:
            words = text.split()
            unknown = {w for w in words if w not in self.known}
            if len(self.known) + len(unknown) > REMEMBERED:
                self.known, self.rows, unknown = {}, [], set(words)
            self._learn(unknown)
            codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            at = np.flatnonzero(codes >= 0)
            starts = at[np.flatnonzero(np.diff(at, prepend=-2) > 1)]
            ends = at[np.flatnonzero(np.diff(at, append=len(words) + 2) > 1)] + 1
            table = self.rows
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                open_.append((len(found), a, np.stack([table[c] for c in codes[a:b]])))
            found.append((base_spans(text), {k: [] for k in KINDS}))
        marks: dict[int, dict[int, int]] = {}
        for (doc, a, _), labels in zip(
            open_, self.field.viterbi([s for _, _, s in open_]), strict=True
        ):
            for t in np.flatnonzero(labels).tolist():
                marks.setdefault(doc, {})[a + t] = int(labels[t])
        for doc, labels in marks.items():
            self._add(texts[doc], labels, *found[doc])
        return found

    @staticmethod
    def _add(text: str, labels: dict[int, int], base, added) -> None:
        taken = sorted(s for spans in base.values() for s in spans)
        tokens = {}
        wanted = {i + d for i in labels for d in (-1, 0, 1)}
        for i, m in enumerate(re.finditer(r"\S+", text)):
            if i in wanted:
                tokens[i] = m
        spans, last = [], (-2, 0)
        for i, label in sorted(labels.items()):
            first = end = tokens[i]
            reach = i
            if LABELS[label] == "email" and _MASK.fullmatch(first[0]):
                # a mask that stands alone takes in the words on both sides
                first, end, reach = tokens.get(i - 1, first), tokens.get(i + 1, end), i + 1
            if spans and last[1] == label and last[0] >= i - 1:
                spans[-1][1] = end.end()
            else:
                spans.append([first.start(), end.end(), label])
            last = (reach, label)
        for a, b, label in spans:
            while a < b and text[a] in _LEFT:
                a += 1
            while b > a and text[b - 1] in _RIGHT:
                b -= 1
            overlaps = any(x < b and y > a for x, y in taken)
            if a < b and not overlaps and plausible(LABELS[label], text[a:b]):
                added[LABELS[label]].append((a, b))


def _listed(*groups: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    return [(k, a, b) for k in KINDS for a, b in sorted(s for g in groups for s in g[k])]


def personal_data(text: Column) -> Column:
    """Struct (base, spans) of arrays of (kind, start, finish): of the rules, and of both."""
    small_batches()
    field = trained()
    span = "array<struct<kind: string, start: int, finish: int>>"

    @F.pandas_udf(f"struct<base: {span}, spans: {span}>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = Finder(field)
        for texts in batches:
            found = finder.find([t or "" for t in texts])
            rows = [
                [
                    [{"kind": k, "start": a, "finish": b} for k, a, b in spans]
                    for spans in (_listed(base), _listed(base, added))
                ]
                for base, added in found
            ]
            yield pd.DataFrame(
                {"base": [r[0] for r in rows], "spans": [r[1] for r in rows]}, dtype=object
            )

    return of(text)
