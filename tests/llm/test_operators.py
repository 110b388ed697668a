"""Operators on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
import time
import uuid

import numpy as np
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from tableops.llm import byte_bpe, embedding_dedup, exact_dedup, lm_scoring, mixing, part_encoder, pii, simhash, toxicity
from tableops.llm.chat_format import PART, format_conversations, read_back
from tableops.llm.components import components
from tableops.llm.embedding_dedup import embedding_groups
from tableops.llm.lm_scoring import cross_entropy_difference
from tableops.llm.token_counts import TokenRollup

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
#: Null, empty, white space, case, ties, repeated rows, a long text; columns with odd names.
ROWS = [
    (1, "The cat sat on the mat", "a", "x", 1.0), (2, "the CAT sat on the mat", "b", "x", 2.0),
    (3, None, None, None, None), (4, "", "a", "", 0.0), (5, " \n\t ", "a", "y", 1.0),
    (6, LONG, "b", "z", 1.0), (6, LONG, "b", "z", 1.0), (7, LONG.upper(), "b", "z", 1.0),
    (None, "no id", "c", None, 3.0), (None, "no id", "c", None, 3.0), (8, "ÄÖ äö", "c", "k", 4.0),
    (9, "äÖ äö", "c", "k", 4.0), (10, "one two", "é", "k", 4.0),
]
SCHEMA = "doc_id long, text string, source string, gid string, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- token counts --------------------------------------------------------------------

CHANGES = (
    "op string, source string, lang string, tokenizer string, n_tokens long, old_source string,"
    " old_lang string, old_tokenizer string, old_tokens long"
)


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_rollup(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / uuid.uuid4().hex))
    assert totals(rollup) == {}
    load = spark.createDataFrame(
        [("insert", "a", "en", "v1", 10, None, None, None, None)] * 2
        + [("insert", None, None, "v1", None, None, None, None, None)]
        + [(None, "a", "en", "v1", 99, None, None, None, None)]
        + [("other", "a", "en", "v1", 99, None, None, None, None)],
        CHANGES,
    )
    assert rollup.apply("1", load)
    assert not rollup.apply("1", load)
    first = {("a", "en", "v1"): (2, 20), (None, None, "v1"): (1, 0)}
    assert totals(rollup) == first
    change = spark.createDataFrame(
        [("revise", "b", "en", "v2", 7, "a", "en", "v1", 10),
         ("delete", None, None, None, None, None, None, "v1", None)], CHANGES,
    )
    assert rollup.apply("2", change)
    second = {("a", "en", "v1"): (1, 10), ("b", "en", "v2"): (1, 7)}
    assert totals(rollup) == second
    rollup.compact()
    assert totals(rollup) == second and not rollup.apply("2", change)
    assert rollup.apply("3", load.limit(0)) and totals(rollup) == second
    rollup.compact()
    assert totals(rollup) == second and rollup.committed("1") and rollup.committed("3")


def test_rollup_failed_commit_is_replaced(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    load = spark.createDataFrame([("insert", "a", "en", "v", 5, None, None, None, None)], CHANGES)
    rollup.apply("1", load)
    (tmp_path / "r" / "delta" / "1" / "_SUCCESS").unlink()
    assert totals(rollup) == {} and rollup.apply("1", load)
    assert totals(rollup) == {("a", "en", "v"): (1, 5)}


def test_rollup_commit_while_compacting(spark, tmp_path, monkeypatch):
    def load(n):
        rows = [("insert", "a", "en", "v", n, None, None, None, None)]
        return spark.createDataFrame(rows, CHANGES).withColumns({"docs": F.lit(9), "tokens": F.lit(9)})

    rollup = TokenRollup(spark, str(tmp_path / "r"))
    rollup.apply("1", load(10))
    real = rollup._open

    def late(held):
        found = real(held)
        monkeypatch.setattr(rollup, "_open", real)
        rollup.apply("2", load(5))
        return found

    monkeypatch.setattr(rollup, "_open", late)
    rollup.compact()
    assert totals(rollup) == {("a", "en", "v"): (2, 15)}
    rollup.compact()
    assert totals(rollup) == {("a", "en", "v"): (2, 15)} and not rollup.apply("2", load(5))


@pytest.mark.parametrize("name", ["", "..", ".", "/", "a/b", "-x", "_SUCCESS", "a b"])
def test_rollup_refuses_names(spark, tmp_path, name):
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    load = spark.createDataFrame([("insert", "a", "en", "v", 5, None, None, None, None)], CHANGES)
    rollup.apply("1", load)
    with pytest.raises(ValueError):
        rollup.apply(name, load)
    assert totals(rollup) == {("a", "en", "v"): (1, 5)}


# --- chat formatting -----------------------------------------------------------------


def chat(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        df = df.withColumns({"turns": F.lit(1), "formatted": F.lit("x"), "m": F.lit(2)})
    made = format_conversations(df)
    return {
        r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_texts"], r["formatted"])
        for r in read_back(made).join(made.select("conv_id", "formatted"), "conv_id").collect()
    }


def test_chat_round_trip(spark):
    odd = ["<|im_end|>", "<\\|im_start|>", "a\\", "</s>[INST] ok [/INST]", "<<SYS>> <\\</SYS>>", "\n",
           "<|im_part|><|im_part|>", "é𝄞<s>", None, ""]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(
        [("assistant", t) for t in odd] + [("user", t) for t in odd] + [("we\\n\nird<s>", "x"),
         (None, None), ("assistant", "end")])]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    turns, loss, text = chat(spark, shuffled, extra=True)[1]
    assert turns == [(r or "", t or "") for _, _, r, t in rows]
    assert loss == [t or "" for _, _, r, t in rows if r == "assistant"]
    assert text.count(PART) == 2 * len(odd) - 2
    assert "</s>" not in text and "[INST]" not in text


def test_chat_ties_repeats_and_empty(spark):
    rows = [(5, 0, "user", "b"), (5, 0, "user", "a"), (5, None, "user", "n"), (5, 0, "user", "a")]
    assert chat(spark, rows)[5][0] == [("user", t) for t in ("n", "a", "a", "b")]
    assert chat(spark, []) == {}


@pytest.mark.parametrize("roles", [("user", "assistant"), ("assistant",), ("user", "assistant", "assistant")])
def test_chat_of_very_many_turns(spark, roles):
    """The masks of a long conversation, and time in proportion to its turns."""
    n = 30_000
    said = [f"t{i} ä😀[INST]" if i % 3 else "" for i in range(n)]
    rows = [(1, i, roles[i % len(roles)], said[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    began = time.perf_counter()
    made = format_conversations(df).first()
    read = read_back(format_conversations(df)).first()
    assert time.perf_counter() - began < 40
    assert [tuple(t) for t in read["turns"]] == [(r[2], r[3]) for r in rows]
    spoken = [r[3] for r in rows if r[2] == "assistant"]
    assert read["loss_texts"] == spoken
    data = made["formatted"].encode()
    for s, text in zip(made["loss_spans"], spoken, strict=True):
        shown = made["formatted"][s["start"] : s["end"]]
        assert shown == text.replace("[INST]", "[\\INST]")
        assert data[s["byte_start"] : s["byte_end"]].decode() == shown


def test_chat_is_native(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = read_back(format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# --- mixing --------------------------------------------------------------------------


def filled(sizes, weights, epochs=3):
    """Shares by repeated resharing."""
    total, fixed = sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        weight = sum(weights[i] for i in open_)
        if not open_ or not weight:
            return [fixed.get(i, epochs * sizes[i]) for i in range(len(sizes))]
        share = {i: (total - sum(fixed.values())) * weights[i] / weight for i in open_}
        over = [i for i in open_ if share[i] > epochs * sizes[i]]
        if not over:
            return [fixed[i] if i in fixed else share[i] for i in range(len(sizes))]
        fixed |= {i: epochs * sizes[i] for i in over}


@pytest.mark.parametrize("ranges", [1, 20_000])
def test_mix(spark, ranges):
    rng = random.Random(3)
    sources = ["a", "b", "c", "d", "é", None]
    share = [400, 5, 3, 20, 1, 7]
    rows = [(i, s, rng.randint(0, 50)) for i, s in enumerate(
        x for s, n in zip(sources, share, strict=True) for x in [s] * n)] + [(0, "a", 7), (0, "a", 7), (None, "a", 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix(df.withColumn("key", F.lit("mine")), range_rows=ranges).collect()
    again = mixing.mix(df.repartition(5), range_rows=ranges).collect()
    strip = lambda rs: sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in rs)
    assert strip(out) == strip(again) and len(out) == len(rows)
    assert {r["key"] for r in out} == {"mine"}
    sizes = [sum(z for _, s, z in rows if s == x) for x in sources]
    goals = filled(sizes, [1, 2, 3, 1, 2, 3])
    for source, size, goal in zip(sources, sizes, goals, strict=True):
        own = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in own} == {size}
        assert own[0]["target"] == pytest.approx(goal)
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_mix_sums_ranges_by_level(spark, digits, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_DIGITS", digits)
    rng = random.Random(digits)
    ranges = {(s, "".join(rng.choice("0123456789abcdef") for _ in range(d))): rng.randint(0, 9)
              for s, d in (("a", 4), (None, 2), ("b", 0), ("c", 1)) for _ in range(300)}
    rows = [(*k, n) for k, n in ranges.items()]
    df = spark.createDataFrame(rows, "source string, range string, range_size long")
    found = {(r["start_source"], r["start_range"]): r["start"] for r in mixing.range_starts(df, 4).collect()}
    assert found == {
        (s, r): sum(n for (s2, r2), n in ranges.items() if s2 == s and r2 < r) for s, r in ranges
    }


def test_mix_with_clashing_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 4)], "doc_id long, source string, size long")
    names = ["Target", "taken", "before", "range", "more", "start", "key", "plan_source", "digits", "a.b"]
    out = mixing.mix(df.withColumns({n: F.lit("mine") for n in names}))
    assert sorted(out.columns) == sorted(
        ["doc_id", "source", "size", *mixing.ADDED, *names[3:]]
    )
    out.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["taken"] for r in back} == {3, 4}
    assert {r[n] for r in back for n in names[3:]} == {"mine"}


def test_mix_empty(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, size long")).collect() == []
    one = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r["taken"] for r in mixing.mix(one).collect()] == [0, 0]


# --- LM scoring ----------------------------------------------------------------------


def brute_losses(texts, target, mu=100.0):
    cut = [lowered(t).encode().split() for t in texts]
    goal = [lowered(t).encode().split() for t in target]
    v = len({w for words in cut + goal for w in words})
    losses = []
    for corpus in (goal, cut):
        uni, pair, context = {}, {}, {}
        for words in corpus:
            before = "start"
            for w in words:
                uni[w] = uni.get(w, 0) + 1
                pair[before, w] = pair.get((before, w), 0) + 1
                context[before] = context.get(before, 0) + 1
                before = w
        total, out = sum(uni.values()), []
        for words in cut:
            before, loss = "start", 0.0
            for w in words:
                p = (pair.get((before, w), 0) + mu * (uni.get(w, 0) + 1) / (total + v)) / (
                    context.get(before, 0) + mu
                )
                loss, before = loss - np.log(p), w
            out.append(loss / max(1, len(words)))
        losses.append(out)
    return losses


def losses_by_id(df):
    return sorted((r["doc_id"] or -1, r["target_loss"], r["background_loss"]) for r in df.collect())


@pytest.mark.parametrize("block", [1 << 21, 500])
def test_lm_scoring(spark, docs, no_docs, block, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK", block)
    monkeypatch.setattr(lm_scoring, "BUCKET", block * 10)
    target = spark.createDataFrame([("the cat",), (None,), ("w1 w2 w3 unseen",)], "text string")
    clashing = docs.withColumns({"target": F.lit(1), "block": F.lit("x"), "words": F.lit(2)})
    found = losses_by_id(cross_entropy_difference(clashing, target))
    texts = [r[1] for r in ROWS]
    goal, background = brute_losses(texts, ["the cat", None, "w1 w2 w3 unseen"])
    expected = sorted((r[0] or -1, g, b) for r, g, b in zip(ROWS, goal, background, strict=True))
    assert np.allclose(found, expected, atol=1e-9)
    assert cross_entropy_difference(no_docs, target).collect() == []
    assert cross_entropy_difference(docs, target.limit(0)).count() == len(ROWS)


def test_lm_scoring_counts_rare_words(spark):
    """Of very many words that occur once, those of the target still tell its texts apart."""
    many = [(i, " ".join(f"r{i}x{k}" for k in range(400))) for i in range(1, 251)]
    rows = [*many, (1000, "r3x7 r9x9 r200x399"), (1001, "other0 other1 other2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("r200x399 r9x9 r3x7",)] * 30, "text string")
    found = losses_by_id(cross_entropy_difference(docs, target))
    goal, background = brute_losses([t for _, t in rows], ["r200x399 r9x9 r3x7"] * 30)
    expected = sorted((i, g, b) for (i, _), g, b in zip(rows, goal, background, strict=True))
    assert np.allclose(found, expected, atol=1e-9)
    score = {i: g - b for i, g, b in found}
    assert min(score, key=score.get) == 1000


# --- byte-level BPE ------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    made = byte_bpe.definition(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
        special_tokens={},
    )
    return byte_bpe.Codec(made), own


ODD = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x85\x1c a'sé𝄞")))


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_bpe_equals_ranks(codec, text):
    ours, theirs = codec
    (ids,) = ours.encode([text])
    assert ids.tolist() == theirs.encode_ordinary(text)
    assert ours.decode(ids) == text.encode()
    if text:
        first, last = ours.offsets(text, ids)
        assert first[0] == 0 and last[-1] == len(text)
        assert all(b > a for a, b in zip(first, last, strict=True))
        assert all(a <= b for a, b in zip(first[1:], last, strict=False))


def test_bpe_columns(spark, docs, no_docs):
    bpe = byte_bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN)

    def coded(df):
        return df.select("text", bpe.encoded(F.col("text")).alias("ids")).select(
            "text", "ids", bpe.decoded(F.col("ids")).alias("back"),
            bpe.offsets(F.col("text"), F.col("ids")).alias("at"),
            bpe.round_trip(F.col("text")).alias("both"),
        )

    for r in coded(docs).collect():
        assert bytes(r["back"]) == (r["text"] or "").encode() and len(r["at"]) == len(r["ids"])
        assert r["both"]["ids"] == r["ids"] and r["both"]["decoded"] == r["back"]
    assert coded(no_docs).collect() == []
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(null.select(bpe.decoded(F.col("ids"))).first()[0]) == b""


def test_bpe_of_parts(codec, monkeypatch):
    monkeypatch.setattr(part_encoder, "AT_ONCE", 10)
    ours, theirs = codec
    texts = [f"a b{i} c{i}  d\n e " * 7 for i in range(30)] + ["", "x" * 5000, " ", "a  " * 9]
    ids = ours.encode(texts)
    assert [i.tolist() for i in ids] == [theirs.encode_ordinary(t) for t in texts]


def test_bpe_remembers_and_forgets(monkeypatch):
    monkeypatch.setattr(part_encoder, "REMEMBERED", 40)
    monkeypatch.setattr(part_encoder, "TOGETHER", 3)
    made = byte_bpe.definition(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    ours = byte_bpe.Codec(made)
    theirs = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
        special_tokens={},
    )
    rng = random.Random(2)
    bits = ["a", "the", " ", " ", "\n", "\n", "\t", "'s", "1", "é.", "end.", "x,", "\x85", "\x1c", " <|endoftext|>",
            "ab cd", "\r\n", "\u0301", "日本", "👍🏽", "²!", "Zürich;"]
    for _ in range(40):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(50)]
        assert [i.tolist() for i in ours.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_bpe_with_another_pattern():
    pattern = r"\S+|\s+"
    ours = byte_bpe.Codec(byte_bpe.definition(byte_bpe.read_ranks(RANKS), pattern))
    theirs = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    texts = ["one two\nthree.", "", "a  b"]
    assert [i.tolist() for i in ours.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


# --- toxicity ------------------------------------------------------------------------


def toxic_rows(n, seed=0):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.choice([5, 30, 200]))
        label = int(i % 4 == 0)
        for _ in range(3 * label):
            words.insert(rng.randrange(len(words)), rng.choice(["Vile,", "awful", "NASTY!"]))
        rows.append((i, " ".join(words), label))
    return rows


def test_toxicity_held_out():
    model = toxicity.train(toxic_rows(300), rounds=3, batches=40)
    scorer = toxicity.Scorer(model)
    rows = toxic_rows(200, seed=1)
    scores = scorer.score([r[1] for r in rows])
    right = [(s >= toxicity.THRESHOLD) == bool(r[2]) for s, r in zip(scores, rows, strict=True)]
    assert np.mean(right) > 0.95
    odd = scorer.score([None, "", " ", "x" * 100_000, LONG, "word1", "word1"])
    assert ((odd >= 0) & (odd <= 1)).all() and odd[0] == odd[1] == odd[2] and odd[5] == odd[6]
    late = "word1 " * 30_000 + "vile awful nasty vile"
    assert scorer.score([late])[0] > scorer.score(["word1 " * 30_004])[0]


def test_toxicity_sample_weighs_labels(spark):
    """Both labels bounded to the same number still calibrate to the share among all labels."""
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    rows = [tuple(r) for r in toxicity.sampled(docs, labels, bound=30).collect()]
    learnt = labels.where(~toxicity.held_out(F.col("doc_id")))
    for label in (0, 1):
        own = [r[3] for r in rows if r[2] == label]
        assert len(own) == 30
        assert sum(own) == pytest.approx(learnt.where(F.col("toxic") == label).count())
    y = np.array([r[2] for r in rows], float)
    stands = np.array([r[3] for r in rows])
    w = toxicity._calibrate(np.zeros(len(rows)), np.ones(len(rows)), y, stands)
    assert 1 / (1 + np.exp(-w[2])) == pytest.approx(np.average(y, weights=stands), abs=0.01)


def test_toxicity_sample_has_one_row_per_document(spark):
    ids = spark.range(40).select(F.col("id").alias("doc_id"))
    text = F.concat(F.lit("text "), F.col("n").cast("string"))
    docs = ids.crossJoin(spark.range(5).select(F.col("id").alias("n"))).select(
        "doc_id", text.alias("text")
    )
    labels = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    rows = toxicity.sampled(docs, labels).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 0
    assert {r["text"] for r in rows} == {"text 0"}


def plain_logit(network, window):
    """One window, word by word and state by state."""
    p, size = network.p, toxicity.STATE

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    inputs = []
    for word in window:
        own = word.strip(".,;:!?")
        lexicon = toxicity.Lexicon([word], network.words)
        marks = [p["tri"][g] for g in lexicon.grams]
        assert len(marks) == max(len(own), 1)
        inputs.append(p["word"][network.words.get(own, len(network.words))] + sum(marks) / len(marks))
    states = np.zeros((len(window), 2 * size))
    for d, order in ((0, range(len(window))), (1, reversed(range(len(window))))):
        h = np.zeros(size)
        for t in order:
            x, rec = inputs[t] @ p["in"][d] + p["bias"][d], p["rec"][d]
            z = sigmoid(x[:size] + h @ rec[:, :size])
            r = sigmoid(x[size : 2 * size] + h @ rec[:, size : 2 * size])
            new = np.tanh(x[2 * size :] + r * (h @ rec[:, 2 * size :]))
            h = z * h + (1 - z) * new
            states[t, d * size : (d + 1) * size] = h
    weights = np.exp([np.tanh(s @ p["att"] + p["attb"]) @ p["attv"] for s in states])
    pooled = sum(w * s for w, s in zip(weights, states, strict=True)) / weights.sum()
    return float(pooled @ p["out"] + p["outb"][0])


def test_toxicity_scores_against_plain_loops():
    model = toxicity.train(toxic_rows(200), rounds=2, batches=30)
    long_ = [r[1] for r in toxic_rows(12, seed=3)] + ["vile, " * 61, "one"]
    for text, score in zip(long_, toxicity.Scorer(model).score(long_), strict=True):
        words = text.lower().split()
        windows = [words[at : at + 24] for at in range(0, max(1, len(words) - 12), 12)]
        best = max(plain_logit(model.network, w) for w in windows)
        a, b, c = model.calibration
        assert score == pytest.approx(1 / (1 + np.exp(-(a * best + b * np.log(len(windows)) + c))), abs=1e-4)


def test_toxicity_calibration_against_plain_steps():
    rng = np.random.default_rng(1)
    x, n = rng.normal(size=200), rng.integers(1, 50, 200)
    y = (x + rng.normal(size=200) > 0.5).astype(float)
    stands = rng.uniform(1, 9, 200)
    w = toxicity._calibrate(x, n, y, stands)

    def loss(w):
        p = 1 / (1 + np.exp(-(w[0] * x + w[1] * np.log(n) + w[2])))
        fit = -(stands / stands.mean() * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        return fit + 0.5 * ((w[0] - 1) ** 2 + w[1] ** 2 + 0.01 * w[2] ** 2)

    for k in range(3):
        for d in (-0.01, 0.01):
            other = w.copy()
            other[k] += d
            assert loss(other) > loss(w)
    assert toxicity._calibrate(x[:0], n[:0], y[:0], stands[:0]).tolist() == [1, 0, 0]


def test_toxicity_windows_come_from_the_whole_text():
    text = "word1 " * 30_000 + "vile " + "word2 " * 30_000
    windows = toxicity.chosen_windows(1, text, {"vile": 5.0, "word1": 0.1})
    assert 4 <= len(windows) <= 8 and sum("vile" in w for w in windows) == 2
    assert toxicity.chosen_windows(1, None, {}) == [[]] and toxicity.windows_of([]) == [[]]
    assert toxicity.windows_of(["a"] * 30) == [["a"] * 24, ["a"] * 18]


def test_toxicity_in_tasks_equals_plain(spark):
    """Learning as Spark jobs from odd tables: null ids and texts, repeated rows, clashing columns."""
    rows = [(i, t, 1, "x") for i, t, _ in toxic_rows(160)] + [(None, "vile", 1, "x"), (5, None, 1, "x")]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, stands string").repartition(4)
    labels = spark.createDataFrame(
        [(i, k) for i, _, k in toxic_rows(160)] + [(None, 1), (7, None)], "doc_id long, toxic int"
    )
    plain = [tuple(r) for r in toxicity.sampled(docs, labels, 100).collect()]
    assert len({r[0] for r in plain}) == len(plain) > 80
    ours, theirs = toxicity.learn(docs, labels, 100), toxicity.train(plain)
    texts = [r[1] for r in toxic_rows(40, seed=9)] + [None, "", LONG]
    np.testing.assert_allclose(toxicity.Scorer(ours).score(texts), toxicity.Scorer(theirs).score(texts), atol=1e-9)
    scored = docs.withColumn("score", toxicity.toxicity(docs, labels, F.col("text"), 100)).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    for empty in (docs.limit(0), docs):
        none = toxicity.toxicity(empty, labels.limit(0), F.col("text"))
        assert {r[0] for r in docs.select(none).collect()} == {0.0}
    assert docs.limit(0).select(toxicity.toxicity(docs, labels, F.col("text"), 100)).collect() == []


def test_toxicity_without_labels():
    assert toxicity.Scorer(toxicity.train([])).score(["a", None]).tolist() == [0, 0]
    assert toxicity.Scorer(toxicity.train([(1, "a", 1)])).score(["a"]).tolist() == [1]


def plain_windows(network, texts):
    """All windows of the texts by the pass that training uses."""
    vocabulary = sorted({w for t in texts for w in t} | {"."})
    number = {w: i for i, w in enumerate(vocabulary)}
    windows = [w for t in texts for w in toxicity.windows_of(t)]
    ids = np.array([[number[w] for w in own] + [-1] * (toxicity.WINDOW - len(own)) for own in windows])
    owner = np.repeat(np.arange(len(texts)), [len(toxicity.windows_of(t)) for t in texts])
    return network.projected(toxicity.Lexicon(vocabulary, network.words)), ids, owner


def test_toxicity_windows_in_blocks_equal_plain_windows(monkeypatch):
    """Neighbours in a batch, its borders and a full store change nothing."""
    network = toxicity.train(toxic_rows(200), rounds=2, batches=30).network
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)] + ["vile", "é,", "...", "a\x00b", "\ud800x", "\u0130"]
    texts = [rng.choices(words, k=k) for k in [0, 0, *range(40), 0, 1000, 61, 0]]
    for batch, remembered in ((2048, 100_000), (7, 90), (1, 1)):
        proj, ids, owner = plain_windows(network, texts)
        best = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(best, owner, network.forward(proj, ids))
        monkeypatch.setattr(toxicity, "BATCH", batch)
        monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
        found, n = toxicity.Scorer(toxicity.Model(network, np.zeros(3), 0.0)).windows(texts)
        np.testing.assert_allclose(found, best, atol=1e-5)
        assert n.tolist() == np.bincount(owner).tolist()
    nothing = toxicity.Scorer(toxicity.Model(network, np.zeros(3), 0.0))
    assert [len(x) for x in nothing.windows([])] == [0, 0] and nothing.windows([[]])[1].tolist() == [1]


def test_toxicity_projects_frequent_words_once(monkeypatch):
    """A store that overflows with rare words keeps those that are used over and over."""
    model = toxicity.train(toxic_rows(200), rounds=1, batches=10)
    often = [f"word{i}" for i in range(20)]
    texts = [" ".join([*often * 5, *(f"rare{i}x{k}" for k in range(40))]) for i in range(60)]
    expected = toxicity.Scorer(model).score(texts)
    monkeypatch.setattr(toxicity, "REMEMBERED", 400)
    asked, begin = [], toxicity.Lexicon.__init__
    monkeypatch.setattr(
        toxicity.Lexicon, "__init__", lambda self, words, known: (asked.extend(words), begin(self, words, known))[1]
    )
    scorer = toxicity.Scorer(model)
    scores = np.concatenate([scorer.score(texts[i : i + 2]) for i in range(0, 60, 2)])
    np.testing.assert_allclose(scores, expected, atol=1e-5)
    assert [asked.count(w) for w in often] == [1] * 20
    assert len(scorer.known) <= 2 * 400


def test_every_token_is_in_the_middle_of_a_window():
    for n in range(200):
        starts = toxicity.window_starts(n)
        covered = {t for s in starts for t in range(s, s + toxicity.WINDOW)}
        assert set(range(n)) <= covered and len(starts) >= 1


def test_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network({"a": 0, "b": 1}, rng)
    net.p = {k: (v * 3).astype(np.float64) for k, v in net.p.items()}
    lex = toxicity.Lexicon(["a", "b,", "ccc", "?"], net.words)
    ids = rng.integers(-1, 4, (5, toxicity.WINDOW))
    y, w = np.array([1.0, 0, 1, 0, 1]), np.ones(5)
    _, g = net.gradients(lex, ids, y, w)
    for name, at in (("rec", (0, 1, 20)), ("in", (1, 2, 3)), ("att", (3, 2)), ("out", (4,)),
                     ("tri", (int(lex.grams[0]), 1)), ("word", (1, 2)), ("bias", (1, 30))):
        old, sides = net.p[name][at], []
        for step in (1e-3, -1e-3):
            net.p[name][at] = old + step
            sides.append(net.gradients(lex, ids, y, w)[0])
        net.p[name][at] = old
        assert g[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-3, abs=2e-4, rel=0.05)


# --- SimHash -------------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42)
        for i in range(max(1, len(words) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for _, text, *_ in ROWS:
        assert simhash.text_fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def joined(nodes, linked):
    """Smallest node of each component, by brute force."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if label[b] < label[a] and linked(a, b):
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("short", [0, 3, 16])
def test_links_connect_like_all_pairs(spark, short):
    rng = random.Random(5)
    fps = set()
    for _ in range(4):
        base = rng.getrandbits(64)
        for _ in range(25):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 2, 3, 5]))))
    signed = [f - (1 << 64) * (f >> 63) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(df, short=short).collect()
    assert all((r["a"] ^ r["b"]) % (1 << 64) and ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 4 for r in links)
    found = {r["node"]: r["component"] for r in components(simhash.links(df, short=short)).collect()}
    expected = joined(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    assert {f: found.get(f, f) for f in signed} == expected


def test_simhash_rows(spark, docs, no_docs):
    out = simhash.simhash_groups(docs).collect()
    assert len(out) == len(ROWS)
    by_fp = {}
    for i, text, *_ in ROWS:
        by_fp.setdefault(f"{brute_fingerprint(text):016x}", []).append(i)
    for r in out:
        ids = [i for i in by_fp[r["fingerprint"]] if i is not None]
        assert r["component_id"] == min(ids, default=None)
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(by_fp)
    assert simhash.simhash_groups(no_docs).collect() == simhash.simhash_dedup(no_docs).collect() == []


# --- components ----------------------------------------------------------------------


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(df.limit(0)).collect() == []


def test_components_of_paths_in_any_order(spark):
    rng = random.Random(3)
    paths = [[2, 5, 4, 3, 1], *(rng.sample(range(20 * i, 20 * i + 20), 6 + i % 7) for i in range(1, 40))]
    edges = [e for p in paths for e in zip(p, p[1:])]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, rows)) == sorted((n, min(p)) for p in paths for n in p)


@pytest.mark.parametrize("path", [[2, 5, 4, 3, 1], [3, 4, 6, 5, 2, 1]])
def test_components_of_one_path(spark, path):
    rows = components(spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")).collect()
    assert sorted(map(tuple, rows)) == sorted((n, 1) for n in path)


# --- exact dedup ---------------------------------------------------------------------


@pytest.mark.parametrize("memory", [exact_dedup.MEMORY, 1, 2000])
def test_exact(docs, no_docs, memory):
    out = exact_dedup.exact_groups(docs, memory=memory).collect()
    groups = {}
    for i, text, *_ in ROWS:
        groups.setdefault(lowered(text), []).append(i)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(out) == len(ROWS)
    for r in out:
        ids = digest[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in out) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    kept = exact_dedup.exact_dedup(docs, memory=memory)
    assert kept.columns == docs.columns
    assert sorted(lowered(r["text"]) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(no_docs).collect() == exact_dedup.exact_dedup(no_docs).collect() == []


def test_grace_compares_contents(tmp_path):
    """Records of one hash are told apart by their contents, at any depth of spilling."""
    rng = random.Random(2)
    records = []
    for gid in range(400):
        c = rng.randrange(60)
        records.append((rng.choice([5, 5, c << 40]) if c % 2 else 5, gid, gid % 97, 1, b"%d" % c * 9, b"%d" % gid))
    fixed = {c: h for h, _, _, _, c, _ in records}
    records = [(fixed[r[4]], *r[1:]) for r in records]
    for memory in (1 << 20, 3000, 1):
        found = {c: (sorted(g), b, n, row) for c, g, _, b, n, row in exact_dedup.grace(records, memory, str(tmp_path))}
        for content in fixed:
            own = [r for r in records if r[4] == content]
            best = max(own, key=lambda r: (r[2], r[1]))
            assert found[content] == (sorted(r[1] for r in own), best[2], len(own), best[5])
        assert len(found) == len(fixed) and not list(tmp_path.iterdir())


# --- personal data -------------------------------------------------------------------


def brute_base(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


PIECES = ["a", "B_", "@", ".", "x.de", "a@b.c", "+", "-", " ", "4111111111111111", "4111 1111-1111 1111",
          "10.0.0.1", "0256", "1", "9", "(", ")", "é", "\n", "%", "+1 (212) 555-0143", "00000000000000000000"]


@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
@settings(max_examples=500, deadline=None)
def test_rules_equal_plain_patterns(text):
    spans = pii.base_spans(text)
    assert [(k, a, b) for k in pii.KINDS for a, b in spans[k]] == brute_base(text)


def test_decoding_with_cuts_is_exact():
    field = pii.trained()
    finder = pii.Finder(field)
    words = [w for line in pii.TRAINING for w in pii.labelled([line])[0][0]]
    rng = random.Random(4)
    for _ in range(60):
        text = rng.choices(words, k=rng.randrange(1, 25))
        (whole,) = field.viterbi([np.stack([field.scores(w) for w in text])])
        finder._learn(set(text))
        opened = [t for t, w in enumerate(text) if finder.known[w] >= 0]
        assert all(t in opened for t in np.flatnonzero(whole))


def test_field_finds_and_leaves():
    finder = pii.Finder(pii.trained())
    texts = ["call (217) 555-0143 now", "pay 4111.1111.1111.1111", "x ana (at) mail (dot) org y",
             "on 2024-01-15, version 2.0. of 1,250,000", None or "", LONG]
    added = [[(k, t[a:b]) for k in a_ for a, b in a_[k]] for t, (_, a_) in zip(texts, finder.find(texts), strict=True)]
    assert added == [[("phone", "(217) 555-0143")], [("card", "4111.1111.1111.1111")],
                     [("email", "ana (at) mail (dot) org")], [], [], []]


def test_long_runs_take_no_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "a.b@" * 50_000, "+1 " * 50_000, "1." * 100_000):
        pii.base_spans(text)


def test_personal_data_column(docs, no_docs):
    out = docs.select("doc_id", pii.personal_data(F.col("text")).alias("f"))
    assert out.count() == len(ROWS) and no_docs.select(pii.personal_data(F.col("text"))).collect() == []
    assert all(r["f"]["base"] == [] for r in out.collect())


# --- embeddings ----------------------------------------------------------------------


def vectors(n=90, d=12, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = np.random.default_rng(i % 7 + 100).normal(size=d)
        v = (base + rng.normal(size=d) * rng.choice([0.05, 0.3, 1.0])).tolist()
        rows.append((i, v, int(rng.integers(0, 2))))
    copies = [(n + i, rows[3][1], rows[3][2]) for i in range(30)] + [(3, rows[3][1], rows[3][2])]
    odd = [(900, None, 1), (901, [0.0] * d, 1), (902, [float("nan")] * d, 1), (903, [1.0] * (d - 1), 1),
           (904, [1.0, None] + [1.0] * (d - 2), 1), (905, [float("inf")] * d, 1), (906, rows[0][1], None),
           (907, [], 1), (None, rows[5][1], rows[5][2]), (908, [x * 1e-200 for x in rows[5][1]], rows[5][2])]
    return rows + copies + odd


def usable(r):
    return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])


@pytest.mark.parametrize(("block", "leaf", "directions"), [(2048, 256, 8), (7, 2, 3), (16, 16, 12)])
def test_embeddings(spark, block, leaf, directions):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({"rep": F.lit(1), "unit": F.lit("x"), "n_links": F.lit(5)})
    out = embedding_groups(df, block=block, leaf=leaf, directions=directions).collect()
    units = [np.array(r[1]) / max(map(abs, r[1])) if usable(r) else None for r in rows]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    n = len(rows)
    link = [[i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93 for j in range(n)] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i]] + [label[j] for j in range(n) if link[i][j]]) for i in range(n)]
    ids = lambda k: [rows[i][0] for i in range(n) if label[i] == k and rows[i][0] is not None]
    expected = sorted(
        (-1 if r[0] is None else r[0], sum(link[i]), min(ids(label[i]), default=-1)) for i, r in enumerate(rows)
    )
    got = [(-1 if r["vec_id"] is None else r["vec_id"], r["n_links"],
            -1 if r["component_id"] is None else r["component_id"]) for r in out]
    assert sorted(got) == expected
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)
    assert embedding_groups(df.limit(0)).collect() == []


def test_embeddings_with_large_and_null_ids(spark):
    big = 2**60
    rows = [(big + 1, [1.0, 0.1], "a"), (big + 3, [1.0, 0.1], "a"), (None, [0.1, -1.0], "a"), (big + 5, [1.0, 1e-300], "b")]
    out = embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(big + 1, 1, big + 1, True), (big + 3, 1, big + 1, False), (None, 0, None, False), (big + 5, 0, big + 5, True)],
        key=str,
    )


def test_vectors_packed_and_unpacked():
    v = np.array([[1.5, -2.0], [0.1, 1.0], [1e300, 0.0], [-0.0, 3.0], [1e-300, 1.0]])
    rows = embedding_dedup.packed(v)
    assert [len(r) for r in rows] == [8, 16, 16, 8, 16]
    assert (embedding_dedup.unpacked(rows, 2) == v).all()
    assert rows[3] == embedding_dedup.packed(np.array([[0.0, 3.0]]))[0]
    assert embedding_dedup.unpacked([], 3).shape == (0, 3)
