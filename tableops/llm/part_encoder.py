"""Token ids of texts by parts that repeat, for byte-level BPE tokenizers of the tokenizers library.

The pattern of such a tokenizer is fixed: a match may begin with one plain space, and white space
is otherwise on its own. So a match always begins at a single space, and at a single line feed,
between characters that are no white space, and what lies between two such places can be encoded
alone. Each different part is encoded once and remembered; a text is then a join of the ids
remembered for its parts. Texts with other white space (double spaces, three line feeds, a space
at an end) are encoded by the library in stretches of bounded size, cut at the same kind of place.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import islice

import numpy as np

#: Fixed value: the pattern for which the above holds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Parts that are remembered between calls; beyond, those not met again are forgotten.
REMEMBERED = 200_000
#: Longest part that stays remembered when others are forgotten, in characters.
SHORT = 64
#: Marks that the pattern keeps apart from a letter or digit before them.
MARKS = ".,;:!?"
#: Parts encoded in one call of the library.
TOGETHER = 4000
#: The byte character of a space.
SPACE = "\u0120"
#: Characters of the texts looked at together, and of those given to the library at a time, which
#: holds much for each token.
AT_ONCE = 400_000
#: White space in some definitions, though not all agree on it: no cut beside these.
UNSURE = "\x1c\x1d\x1e\x1f\x85"


class PartEncoder:
    """Ids of texts as little-endian 32-bit integers in bytes; one for a Python worker.

    `built` gives, when first needed, the tokenizer, one of the same model that takes matches in
    byte characters as they are, and the bytes of each id. A null or empty text has no ids.
    """

    def __init__(self, built: Callable[[], tuple]) -> None:
        self._make, self._tokenizer = built, None
        self._known: dict[str, bytes] = {}
        self._again: set[str] = set()

    def _build(self) -> None:
        if self._tokenizer is None:
            # one task, one core
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self._tokenizer, self._words, self._lengths = self._make()
            self._make = None
            self._feed = self._library(["\n"])[0]

    def _library(self, texts: list[str]) -> list[bytes]:
        encodings = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32).tobytes() for e in encodings]

    @staticmethod
    def _safe(part: str) -> bool:
        """The part, which follows a space or begins with a line feed, can be encoded alone."""
        body = part[1:] if part[:1] == "\n" else part
        if not body:
            return part == "\n"
        first, last = body[0], body[-1]
        return not (first.isspace() or last.isspace() or first in UNSURE or last in UNSURE)

    def _learn(self, parts: set[str]) -> None:
        """Remember the parts that can be encoded alone."""
        known = self._known
        fresh = {p for p in parts if self._safe(p)}
        # a mark after a letter or digit is a match of its own, so only the word is new
        marked = [p for p in fresh if p[-1] in MARKS and p[-2:-1].isalnum() and p[-2] < "\u0250"]
        fresh.difference_update(marked)
        fresh |= {p[:-1] for p in marked}.difference(known)
        words, others = [], []
        for part in fresh:
            plain = part.isascii() and (part.isalpha() or part[1:].isalpha() and part[0] == "\n")
            (words if plain else others).append(part)
        for at in range(0, len(words), TOGETHER):
            self._learn_words(words[at : at + TOGETHER])
        for at in range(0, len(others), TOGETHER):
            some = others[at : at + TOGETHER]
            coded = self._library([p if p[0] == "\n" else " " + p for p in some])
            known.update(zip(some, coded, strict=True))
        ends = {m: self._library(["a" + m])[0][4:] for m in {p[-1] for p in marked}}
        known.update((p, known[p[:-1]] + ends[p[-1]]) for p in marked)

    def _learn_words(self, parts: list[str]) -> None:
        """Of ASCII letters alone: one match each, so the pattern needn't be looked for.

        They go to the model as a list of matches; the bytes of its tokens tell which are whose.
        """
        matches = [p[1:] if p[0] == "\n" else SPACE + p for p in parts]
        encoded = self._words.encode_batch_fast([matches], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded[0].ids, np.int32)
        ends = np.searchsorted(
            np.cumsum(self._lengths[ids]), np.cumsum(np.fromiter(map(len, matches), np.int64))
        )
        raw, at = ids.tobytes(), [0, *((ends + 1) * 4).tolist()]
        known, feed = self._known, self._feed
        for part, a, b in zip(parts, at, at[1:], strict=False):
            known[part] = feed + raw[a:b] if part[0] == "\n" else raw[a:b]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text."""
        self._build()
        out, at = [], 0
        while at < len(texts):
            first, held = at, 0
            while at < len(texts) and (at == first or held < AT_ONCE):
                held += len(texts[at] or "")
                at += 1
            out += self._encode(texts[first:at])
        return out

    def whole(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, which the library gets as it is."""
        self._build()
        return [self._library([text])[0] if text else b"" for text in texts]

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        rows: list[list[str] | None] = []
        unknown: set[str] = set()
        known = self._known
        for text in texts:
            if not text:
                rows.append([])
                continue
            spaced = text.replace("\n", " \n")
            if "\n \n " in spaced or "  " in spaced or spaced.endswith(("\n \n", " ")):
                rows.append(None)
                continue
            parts = spaced.split(" ")
            # the first part follows nothing: encoded after a line feed that is cut off again
            parts[0] = "\n" + parts[0]
            unknown.update(parts)
            rows.append(parts)
        used = unknown
        unknown = used.difference(known)
        self._again |= used
        self._again -= unknown
        self._learn(unknown)
        out = []
        for text, parts in zip(texts, rows, strict=True):
            try:
                ids = None if parts is None else b"".join(map(known.__getitem__, parts))[4:]
            except KeyError:
                ids = None
            out.append(self._in_stretches(text) if ids is None else ids)
        self._forget()
        return out

    def _forget(self) -> None:
        """When there are too many parts, keep those that were met again since they were learnt."""
        known, again = self._known, self._again
        if len(known) > REMEMBERED:
            if len(again) > REMEMBERED // 2:
                again = set(islice(again, REMEMBERED // 2))
            self._known = {p: known[p] for p in again if p in known and len(p) <= SHORT}
            self._again = set()

    def _in_stretches(self, text: str) -> bytes:
        """Ids of a text with white space of any kind."""
        found, stretch, held = [], [], 0
        for part in cut(text):
            stretch.append(part)
            held += len(part)
            if held >= AT_ONCE:
                found += self._library(["".join(stretch)])
                stretch, held = [], 0
        if stretch:
            found += self._library(["".join(stretch)])
        return b"".join(found)


def cut(text: str) -> list[str]:
    """The text cut before single spaces between characters that are no white space."""
    words = text.split(" ")
    parts, part = [], [words[0]]
    for before, word in zip(words, words[1:], strict=False):
        last, first = before[-1:], word[:1]
        if (
            first and last
            and not (first.isspace() or last.isspace())
            and first not in UNSURE and last not in UNSURE
        ):
            parts.append(" ".join(part))
            part = ["", word]
        else:
            part.append(word)
    parts.append(" ".join(part))
    return parts
