"""Packing, Merkle manifest and periodic runs against plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tableops.llm import merkle
from tableops.llm.best_fit_packing import BestFitPacker, byte_level_definition, cuts, packed_pieces
from tableops.llm.bin_completion import best_fit, fillings, least_bins, least_waste, pack
from tableops.llm.periodic_runs import periodic_runs, runs_of
from tableops.llm.queries import op12_merkle_manifest, op13_periodic_runs, repeating
from tableops.llm.recompression import Grammar
from tableops.llm.shared import table, written

JSON, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, piece int, task int,"
    " pos long, tree string, digest string, ids binary, runs int, length long, ladder string"
)
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "The cat sat on the mat", "en", "b"), (2, None, None, None), (3, "", "en", ""),
    (4, " \n\t ", "en", "b"), (5, LONG, "en", "b"), (5, LONG, "en", "b"), (None, "no id", "c", None),
    (None, "no id", "c", None), (8, "Ä日本👍🏽́ <|endoftext|> x", "c", "é"), (9, "a\n" * 40, "c", "b"),
    (10, "ab " * 700, "c", "b"), (-7, "x y " * 9 + "z", "c", "z"), (12, "a\x85b\xa0c d", "c", "z"),
    *[(100 + i, "same text", "d", "hot") for i in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), 1, 2, 3, "t", "d", b"i", 4, 5, "l") for r in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


# --- bin completion ------------------------------------------------------------------


def fewest(items, capacity):
    """Plain search over all packings."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + items[i] <= capacity:
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def counted(items, capacity):
    return [Counter(items)[size] for size in range(capacity + 1)]


def held(plan, capacity):
    assert all(n > 0 and sum(s * k for s, k in fill) <= capacity for n, fill in plan)
    items = Counter()
    for n, fill in plan:
        for size, k in fill:
            items[size] += n * k
    return items


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 40).flatmap(lambda c: st.tuples(
    st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_packing_is_the_best(case):
    capacity, items = case
    counts, least = counted(items, capacity), fewest(items, capacity)
    plan = pack(counts, capacity)
    assert held(plan, capacity) == Counter(items)
    assert sum(n for n, _ in plan) == least
    assert least_bins(counts, capacity) <= least
    assert held(best_fit(counts, capacity), capacity) == Counter(items)


def test_completion_beats_best_fit():
    items, capacity = [28, 25, 20, 16, 13, 12, 11, 10, 10], 50
    counts = counted(items, capacity)
    assert sum(n for n, _ in best_fit(counts, capacity)) == 4
    assert fewest(items, capacity) == sum(n for n, _ in pack(counts, capacity)) == 3
    many = [1000 * n for n in counts]
    plan = pack(many, capacity)
    assert held(plan, capacity) == Counter({s: n for s, n in enumerate(many) if n})
    assert sum(n for n, _ in plan) < sum(n for n, _ in best_fit(many, capacity))


def test_fillings_and_waste_bound():
    counts = counted([60, 30, 25, 10, 5], 100)
    assert fillings(counts, 30, 100) == [(0, ((30, 1),))]
    # 25 + 10 + 5 fills 40; 30 + 10 does too; 30 + 5 is dominated by 30 + 10
    # and so does 25 + 10 + 5, unless one item could stand for two: 30 is 25 + 5
    assert [f for _, f in fillings(counts, 40, 100)] == [((30, 1), (10, 1))]
    assert fillings(counts, 4, 100) == [(4, ())] and fillings(counts, 4, 3) == []
    assert least_waste(counted([90, 80, 70], 100), 100) == 60
    assert least_waste(counted([90, 80, 20, 20], 100), 100) == 10


# --- packing documents ---------------------------------------------------------------


@lru_cache
def reference():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return tokenizer


def reference_ids(text):
    return [*reference().encode(text or "", add_special_tokens=False).ids, 2]


def test_cuts():
    assert cuts(1, 4) == [(0, 1)] and cuts(4, 4) == [(0, 4)] and cuts(8, 4) == [(0, 4), (4, 4)]
    assert cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(spark, docs, capacity):
    rows = packed_pieces(docs, JSON, PATTERN, capacity).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    wanted = Counter()
    for doc_id, text, *_ in TEXTS:
        ids = np.array(reference_ids(text), "<u4")
        for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
            crc = zlib.crc32(ids[start : start + length].tobytes())
            wanted[doc_id, piece, start, length, crc] += 1
    assert wanted == Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows
    )
    lengths = [r["length"] for r in rows]
    assert len(by_sequence) <= sum(n for n, _ in best_fit(counted(lengths, capacity), capacity))


def test_sequences_hold_the_ids(spark, docs):
    packer = BestFitPacker(spark, JSON, PATTERN, 256)
    placed = packer.placed(written(packer.pieces(docs), "pieces"))
    joined = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packer.sequences(placed).collect()}
    for r in placed.collect():
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == own


def test_packing_no_documents(spark, no_docs):
    assert packed_pieces(no_docs, JSON, PATTERN).collect() == []


def test_other_definitions_are_refused(spark, tmp_path):
    made = json.loads(byte_level_definition(JSON))
    made["model"]["merges"][0], made["model"]["merges"][1] = made["model"]["merges"][1], made["model"]["merges"][0]
    (tmp_path / "t.json").write_text(json.dumps(made))
    with pytest.raises(ValueError):
        byte_level_definition(str(tmp_path / "t.json"))
    with pytest.raises(ValueError):
        byte_level_definition(public_tokenizers.path("word_bpe_49k.json"))


# --- Merkle manifest -----------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source):
    n_chars = len(text or "")
    fields = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def plain_manifest(rows, change):
    """Every tree built and every path folded with plain digests."""
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append(row)

    def folded(levels, at, digest):
        siblings = ""
        for level in levels[:-1]:
            run = level[at // 3 * 3 : at // 3 * 3 + 3]
            left, right = "".join(run[: at % 3]), "".join(run[at % 3 + 1 :])
            siblings, digest, at = siblings + left + right, sha(left + digest + right), at // 3
        return digest, siblings

    def levels_of(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
        return levels

    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source, members in trees.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        built[source] = levels_of([plain_leaf(*r) for r in members])
    over = levels_of([built[s][-1][0] for s in order])
    out = []
    for source, members in trees.items():
        for at, row in enumerate(members):
            changed = plain_leaf(row[0], change(row), row[2], row[3]) if change else built[source][0][at]
            digest, below = folded(built[source], at, changed)
            digest, above = folded(over, order.index(source), digest)
            out.append(
                (row[0], built[source][0][at], built[source][-1][0], over[-1][0], sha(below + above), digest,
                 digest == over[-1][0])
            )
    return Counter(out)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_manifest(spark, docs):
    assert found(merkle.manifest(docs)) == plain_manifest(TEXTS, None)
    verified = {v for *_, v in found(merkle.manifest(docs))}
    assert verified == {True}


@pytest.mark.parametrize("block", [1, 2])
def test_manifest_of_many_blocks(spark, monkeypatch, block):
    # small blocks: trees of several stages, a hot source, lone leaves and short last runs
    monkeypatch.setattr(merkle, "LEVELS", block)
    monkeypatch.setattr(merkle, "BLOCK", 3**block)
    rows = [(i, f"line {i}\nnext", "en", "hot") for i in range(83)]
    rows += [(1000 + i, None if i % 5 else f"\n{i}", None, f"s{i % 11}") for i in range(25)]
    rows += [(2000, "", "x", None), (7, "line 7\nnext", "en", "hot")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA.split(", piece")[0]).repartition(7)
    cut = merkle.manifest(df, lambda text: F.when(F.col("doc_id") % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))

    original = plain_manifest(rows, None)
    assert {r[:5] for r in found(cut)} == {r[:5] for r in original}
    assert len(cut.collect()) == len(rows)
    for r in cut.collect():
        text = next(t for i, t, *_ in rows if i == r["doc_id"])
        assert r["verified"] == (r["doc_id"] % 2 == 1 or "\n" not in (text or ""))


def test_manifest_no_documents(spark, no_docs):
    assert merkle.manifest(no_docs).collect() == []


def test_manifest_query_against_plain(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]

    def leaf(r):
        fields = [None if x is None else str(x) for x in (r[0], r[3], r[2], r[4], r[1])]
        return sha("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))

    query = op12_merkle_manifest(spark, sf_dir)
    assert query.columns == COLUMNS
    for r in query.collect():
        row = next(x for x in rows if x[0] == r["doc_id"])
        assert r["leaf"] == leaf(row)
        tampered = zlib.crc32(str(row[0]).encode()) % 2 == 0 and "\n" in (row[1] or "")
        assert r["verified"] == (not tampered)


def test_states_are_resumed():
    parent = merkle.Parent(["a" * 64, "b" * 64, "c" * 64])
    for slot in range(3):
        children = ["a" * 64, "b" * 64, "c" * 64]
        children[slot] = "d" * 64
        assert parent.folded(slot, "d" * 64) == sha("".join(children))
        assert parent.folded(slot, "d" * 64) == sha("".join(children))


# --- periodic runs -------------------------------------------------------------------


def plain_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            end = j + q
            if end - i >= max(6, 4 * q) and not any(
                all(words[k] == words[k + d] for k in range(i, end - d)) for d in range(1, q)
            ):
                out.add((i, end - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 6, 7, 12, 30, 60, 120]), rng.choice([1, 2, 3, 50])
    words = [b"%d" % rng.randint(1, k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 5))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_against_plain():
    rng = random.Random(5)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 6))]
        for words, runs in zip(texts, runs_of(texts), strict=True):
            assert [tuple(r) for r in runs.tolist()] == plain_runs(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=80), st.data())
def test_extensions(symbols, data):
    # marks at both ends, as the grammar asks for
    s = [7, *symbols, 8]
    a = data.draw(st.integers(1, len(symbols)))
    b = data.draw(st.integers(1, len(symbols)).filter(lambda x: x != a)) if len(symbols) > 1 else a
    if a == b:
        return
    a, b = min(a, b), max(a, b)
    right = 0
    while s[a + right] == s[b + right]:
        right += 1
    left = 0
    while s[a - left] == s[b - left]:
        left += 1
    grammar = Grammar(np.array(s))
    assert grammar.extend(np.array([a]), np.array([b]), 1).tolist() == [right]
    assert grammar.extend(np.array([a]), np.array([b]), -1).tolist() == [left]


def test_runs_of_long_texts():
    assert [r.tolist() for r in runs_of([[b"a"] * 100_000, [], [b"x"]])] == [[[0, 100_000, 1]], [], []]
    words = [b"%d" % (i % 7) for i in range(50_000)]
    assert runs_of([words])[0].tolist() == [[0, 50_000, 7]]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_operator(spark, docs, no_docs):
    rows = periodic_runs(docs).collect()
    wanted = Counter()
    for doc_id, text, *_ in TEXTS:
        words = (text or "").encode().split()
        runs = [(0, len(words), 977)] if text == LONG else plain_runs(words)
        wanted[doc_id, len(words), tuple(runs), collapsed(words, runs).decode()] += 1
    assert wanted == Counter(
        (r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in rows
    )
    assert periodic_runs(no_docs).collect() == []


def plain_answer(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len((text or "").encode().split())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha(listed), hashlib.sha256(collapsed(words, runs)).hexdigest(),
    )


def test_runs_query_against_plain(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    # the plain version is quadratic in the words
    short = {r["doc_id"]: r["text"] for r in rows if len((r["text"] or "").split()) < 1500}
    query = op13_periodic_runs(spark, sf_dir)
    assert query.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    answers = {r["doc_id"]: tuple(r) for r in query.collect()}
    assert len(answers) == len(rows) and len(short) > 150
    assert {i: answers[i] for i in short} == {i: plain_answer(i, t) for i, t in short.items()}
    assert sum(a[1] > 0 for a in answers.values()) > 5


def test_repeating_odd_rows(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    texts = [None, "", " \t ", "one", "a b c d e f g h i j k l m n", "ä\n日 x"]
    rows = [*zip(ids, texts, strict=True), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r[0]: r[1] for r in df.select("doc_id", repeating(F.col("doc_id"), F.col("text"))).collect()}
    assert made[None] == "null id" and not made[ids[0]] and made[ids[1]] == made[ids[2]] == ""
    assert made[ids[3]] == "one"
