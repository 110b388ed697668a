"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The vocabulary comes as a file of ranks (base64 of the token's bytes, rank). Bytes are mapped to
printable characters as byte-level BPE does, the merges are found by taking each token apart with
the ranks before its own, and both make a tokenizer whose ids are the ranks. The definition is
built on the driver and broadcast; its size is that of the vocabulary.

Texts are encoded by their parts (`part_encoder`): with the usual pattern of byte-level BPE a match
always begins at certain places, so parts that repeat are encoded once and remembered up to a bound.
With any other pattern the library gets each text whole.

`encoded` gives the ids and, if asked, where each token begins and ends in characters. Tokens can
hold part of a character: both parts then have the offsets of the whole character. `decoded`
turns the characters of the tokens back to bytes and joins them, so split characters are whole
again; bytes that are no UTF-8 stay as they are in the binary result.

A null or empty text has no ids, and decodes to no bytes; a null array of ids is treated alike.
An id outside the vocabulary fails the job. Lone surrogates cannot come out of Parquet.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .part_encoder import PATTERN, PartEncoder
from .shared import give_back, small_batches

#: Largest definition that is broadcast, in characters.
LARGEST = 256 << 20


def byte_characters() -> list[str]:
    """Character of each byte: itself if printable in Latin-1, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    characters, following = [], 256
    for b in range(256):
        characters.append(chr(b if b in shown else following))
        following += b not in shown
    return characters


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last merge that makes a token, by the ranks below its own."""
    own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, own) for a, b in zip(parts, parts[1:], strict=False)]
        low = min(joined)
        if low >= own:
            return None
        at = joined.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def definition(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer as the library's JSON."""
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1 and (pair := _halves(token, ranks)):
            merges.append([text[pair[0]], text[pair[1]]])
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {
                "type": "Sequence",
                "pretokenizers": [
                    {
                        "type": "Split",
                        "pattern": {"Regex": pattern},
                        "behavior": "Isolated",
                        "invert": False,
                    },
                    {
                        "type": "ByteLevel",
                        "add_prefix_space": False,
                        "trim_offsets": False,
                        "use_regex": False,
                    },
                ],
            },
            "post_processor": None,
            "decoder": {
                "type": "ByteLevel",
                "add_prefix_space": False,
                "trim_offsets": False,
                "use_regex": False,
            },
            "model": {
                "type": "BPE",
                "dropout": None,
                "unk_token": None,
                "continuing_subword_prefix": None,
                "end_of_word_suffix": None,
                "fuse_unk": False,
                "byte_fallback": False,
                "ignore_merges": True,
                "vocab": {text[t]: r for t, r in ranks.items()},
                "merges": merges,
            },
        }
    )


class Codec:
    """A vocabulary in a task; the tokenizer itself is built when something is encoded."""

    def __init__(self, tokenizer_json: str) -> None:
        made = json.loads(tokenizer_json)
        self.pattern = made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = made["model"]["vocab"]
        self.token_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for shown, rank in vocabulary.items():
            self.token_bytes[rank] = bytes(back[c] for c in shown)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.encoder = PartEncoder(lambda: self._built(tokenizer_json))

    def _built(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        return tokenizer, Tokenizer(tokenizer.model), self.lengths

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        if self.pattern == PATTERN:
            return [np.frombuffer(ids, np.int32) for ids in self.encoder.encode(texts)]
        # another pattern may match across any place, so texts go to the library whole
        return [np.frombuffer(ids, np.int32) for ids in self.encoder.whole(texts)]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) character of each token."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        # number of the character each byte belongs to
        owner = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return owner[starts], owner[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def codec_of(tokenizer_json: str) -> Codec:
    """One codec for all tasks of a Python worker."""
    return Codec(tokenizer_json)


class ByteBpe:
    """Encoding and decoding as columns, for one vocabulary."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str) -> None:
        small_batches()
        made = definition(read_ranks(ranks_path), pattern)
        if len(made) > LARGEST:
            raise ValueError("the vocabulary is too large to broadcast")
        self._definition = spark.sparkContext.broadcast(made)

    def encoded(self, text: Column) -> Column:
        """Array of ids."""
        shared = self._definition

        @F.pandas_udf("array<int>")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = codec_of(shared.value)
            for texts in batches:
                yield pd.Series(codec.encode(texts.tolist()), dtype=object)
            give_back()

        return of(text)

    def round_trip(self, text: Column) -> Column:
        """Struct of the ids and the bytes they decode to, in one pass over the texts."""
        shared = self._definition

        @F.pandas_udf("ids array<int>, decoded binary")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            codec = codec_of(shared.value)
            for texts in batches:
                ids = codec.encode(texts.tolist())
                decoded = pd.Series([codec.decode(i) for i in ids], dtype=object)
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": decoded})
            give_back()

        return of(text)

    def offsets(self, text: Column, ids: Column) -> Column:
        """Array of (first, last) characters, last exclusive, one for each id."""
        shared = self._definition

        @F.pandas_udf("array<array<int>>")
        def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            codec = codec_of(shared.value)
            for texts, id_lists in batches:
                rows = []
                for text_, ids_ in zip(texts, id_lists, strict=True):
                    if not text_ or ids_ is None or not len(ids_):
                        rows.append([])
                        continue
                    first, last = codec.offsets(text_, np.asarray(ids_, np.int64))
                    rows.append(np.stack([first, last], 1).astype(np.int32).tolist())
                yield pd.Series(rows, dtype=object)

        return of(text, ids)

    def decoded(self, ids: Column) -> Column:
        """The bytes of the tokens, as binary."""
        shared = self._definition

        @F.pandas_udf("binary")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = codec_of(shared.value)
            for id_lists in batches:
                yield pd.Series(
                    [b"" if i is None else codec.decode(i) for i in id_lists], dtype=object
                )

        return of(ids)
